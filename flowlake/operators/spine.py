"""Calendar spine (one row per token per day) and densification.

``explode(sequence(start, as_of, 1 day))`` is a narrow Generate: the spine is
built where the (small, deduplicated) token rows live, with no shuffle. Its
size is tokens × days, the same as the densified output.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_tokens(tokens: DataFrame, keys: list[str], start_col: str = "start_date") -> DataFrame:
    """``SELECT keys…, min(start_date) … GROUP BY keys`` (7-column dedup)."""
    return tokens.groupBy(*keys).agg(F.min(start_col).alias(start_col))


def calendar_spine(tokens: DataFrame, as_of: dt.date, keys: list[str],
                   start_col: str = "start_date", window_start: dt.date | None = None,
                   out: str = "dt") -> DataFrame:
    """One row per token row and day from its start (or ``window_start`` if later) to ``as_of``.

    Tokens whose start lies after ``as_of`` produce no rows (``sequence``
    would otherwise fail or count backwards); NULL starts produce none either.
    """
    stop = F.lit(as_of)
    start = F.col(start_col)
    if window_start is not None:
        # greatest() skips NULL in Spark; keep NULL starts NULL explicitly.
        start = F.when(start.isNull(), None).otherwise(F.greatest(start, F.lit(window_start)))
    return (tokens
            .select(*keys, start.alias("_start"))
            .filter(F.col("_start").isNotNull() & (F.col("_start") <= stop))
            .select(*keys, F.explode(F.sequence(F.col("_start"), stop,
                                                F.expr("INTERVAL 1 DAY"))).alias(out)))


def densify(spine: DataFrame, flows: DataFrame, on: list[str], value: str,
            out: str, fill=0) -> DataFrame:
    """spine ⟕ flows on ``on``; missing values become ``fill``."""
    right = flows.select(*on, F.col(value).alias("_v"))
    joined = spine.join(right, on=on, how="left")
    return joined.withColumn(out, F.coalesce(F.col("_v"), F.lit(fill).cast("double"))).drop("_v")
