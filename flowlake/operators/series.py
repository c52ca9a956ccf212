"""Per-day and per-token series operators: last-of-day, forward fill, running sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_of_day(df: DataFrame, keys: list[str], value, time: str,
                tiebreak: str | None = None, out: str = "index") -> DataFrame:
    """``max_by(value, time)`` per keys: the value at the latest time of the day.

    A NULL value at the latest time yields NULL (not the previous value).
    ``tiebreak`` (e.g. a log index) makes equal timestamps deterministic.
    Partial aggregation keeps one candidate per key per task before the shuffle.
    """
    v = F.col(value) if isinstance(value, str) else value
    order = F.struct(F.col(time), F.col(tiebreak)) if tiebreak else F.col(time)
    return df.groupBy(*keys).agg(F.max_by(v, order).alias(out))


def forward_fill(df: DataFrame, partition: list[str], order: str, col: str,
                 out: str | None = None) -> DataFrame:
    """``coalesce(x, last_value(x) IGNORE NULLS OVER (PARTITION BY … ORDER BY …))``.

    Leading NULLs stay NULL. The window shuffles by the partition columns,
    i.e. by token; each token contributes one row per day, so no key is hot.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    c = F.col(col)
    return df.withColumn(out or col, F.coalesce(c, F.last(c, ignorenulls=True).over(w)))


def running_sum(df: DataFrame, partition: list[str], order: str, col: str,
                out: str) -> DataFrame:
    """``SUM(x) OVER (PARTITION BY … ORDER BY …)`` with the default RANGE frame
    (rows sharing an order value get the same total)."""
    w = Window.partitionBy(*partition).orderBy(order)
    return df.withColumn(out, F.sum(F.col(col)).over(w))
