"""Join helpers with an explicit size policy.

A dimension is broadcast only when its size is *known* to be bounded: seeds
carry their row count from the file they were read from, and a derived
dimension is checked with a bounded count (``limit(n+1).count()`` never reads
more than n+1 rows past the filter). Anything larger stays a shuffle join, and
AQE may still turn it into a broadcast at run time from the real shuffle size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row ceiling for an explicit broadcast hint. A token/price dimension row is
# ~200 bytes, so this keeps a broadcast well under 20 MB per executor.
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, known_rows: int | None = None,
                      max_rows: int = MAX_BROADCAST_ROWS,
                      check: bool = False) -> DataFrame:
    """Broadcast ``df`` only behind a size bound.

    ``known_rows`` – the row count is known without running a job (seed
    files, inline tables). ``check=True`` – count at most ``max_rows + 1`` rows
    to decide; otherwise leave the choice to AQE.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    if check and df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def semi_join(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """``JOIN (SELECT DISTINCT keys …) USING (keys)`` == LEFT SEMI JOIN.

    A semi join never duplicates left rows, so the DISTINCT is not needed.
    """
    return df.join(keys_df.select(*on), on=on, how="left_semi")


def anti_join(df: DataFrame, keys_df: DataFrame, on: list[str]) -> DataFrame:
    """``LEFT JOIN t … WHERE t.key IS NULL`` == LEFT ANTI JOIN (NULL keys never match)."""
    return df.join(keys_df.select(*on), on=on, how="left_anti")
