"""Series scans in blocks with a carry, and balances as runs.

A running sum or forward fill over one token is sequential.  Cut into blocks
(months), only one row per block has to be scanned in order:

1. each block is reduced to its sum (or its last value that is not NULL),
2. an exclusive scan over the few block rows gives what each block starts from,
3. every block is scanned on its own, starting from that carry.

The wide windows are partitioned by (token, block), so a hot token is spread over
as many tasks as it has blocks; the window of step 2 has one row per block.

``balance_runs`` keeps balances compressed as [from, to) runs between changes.
Days are made only at the end, so what is sorted and joined follows the events,
not tokens x days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "month"


def _block(order: str, block: str) -> Column:
    return F.trunc(F.col(order), block)


def _attach(df: DataFrame, carries: DataFrame, partition: list[str]) -> DataFrame:
    """The carry of each row's block; keys match null-safe."""
    keys = [*partition, "_block"]
    right = carries.select(*(F.col(k).alias(f"_r_{k}") for k in keys), "_carry")
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(right, match, "left").drop(*(f"_r_{k}" for k in keys))


def blocked_running_sum(df: DataFrame, partition: list[str], order: str, col: str, out: str,
                        block: str = BLOCK, start: DataFrame | None = None, start_col: str = "balance") -> DataFrame:
    """``SUM(col) OVER (PARTITION BY partition ORDER BY order)``, RANGE frame, block by block.

    ``order`` is a date.  ``start`` holds balances to begin with (partition
    columns and ``start_col``, one row each): an increment then needs only its own
    rows.  Like the window, a sum of nothing but NULLs is NULL.
    """
    rows = df.withColumn("_block", _block(order, block))
    sums = rows.groupBy(*partition, "_block").agg(F.sum(col).alias("_sum"))
    scan = Window.partitionBy(*partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carries = sums.withColumn("_carry", F.sum("_sum").over(scan)).drop("_sum")
    if start is not None:
        first = start.select(*(F.col(k).alias(f"_s_{k}") for k in partition), F.col(start_col).alias("_start"))
        match = F.lit(True)
        for k in partition:
            match = match & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        carries = carries.join(first, match, "left").drop(*(f"_s_{k}" for k in partition))
        both = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_start"), F.lit(0))
        carries = carries.withColumn("_carry", F.when(F.col("_carry").isNotNull() | F.col("_start").isNotNull(), both)).drop("_start")
    inside = Window.partitionBy(*partition, "_block").orderBy(order)
    own = F.sum(col).over(inside)
    summed = rows.withColumn("_own", own)
    total = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_own"), F.lit(0))
    out_col = F.when(F.col("_carry").isNotNull() | F.col("_own").isNotNull(), total)
    return _attach(summed, carries, partition).withColumn(out, out_col).drop("_block", "_own", "_carry")


def blocked_forward_fill(df: DataFrame, partition: list[str], order: str, col: str, out: str | None = None,
                         block: str = BLOCK) -> DataFrame:
    """``coalesce(col, last_value(col) IGNORE NULLS)``, block by block; leading NULLs stay.

    "Last seen" is associative, so a block is reduced to its latest value that is
    not NULL, whatever tasks its rows are in.
    """
    rows = df.withColumn("_block", _block(order, block))
    seen = rows.groupBy(*partition, "_block").agg(
        F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order))).alias("_last"))
    scan = Window.partitionBy(*partition).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carries = seen.withColumn("_carry", F.last("_last", ignorenulls=True).over(scan)).drop("_last")
    inside = Window.partitionBy(*partition, "_block").orderBy(order)
    filled = rows.withColumn("_own", F.coalesce(F.col(col), F.last(col, ignorenulls=True).over(inside)))
    return (_attach(filled, carries, partition)
            .withColumn(out or col, F.coalesce(F.col("_own"), F.col("_carry"))).drop("_block", "_own", "_carry"))


def balance_runs(tokens: DataFrame, flows: DataFrame, on: list[str], as_of: dt.date, start_col: str = "start_date",
                 date_col: str = "dt", amount: str = "amount", out: str = "balance") -> DataFrame:
    """Balances as runs: the token columns, ``valid_from``, ``valid_to`` (exclusive), the net of the first day, balance.

    ``tokens`` has one row per token (``on`` columns unique) with its start;
    ``flows`` one row per (on, day).  A run begins at the token's start (balance 0
    unless a flow falls on that day) and at each day with a flow from then on; the
    last run ends after ``as_of``.  Flows before the start or after ``as_of``, and
    tokens that start later, give nothing, as on the calendar.
    """
    stop = F.lit(as_of)
    live = tokens.filter(F.col(start_col).isNotNull() & (F.col(start_col) <= stop))
    starts = live.select(*on, F.col(start_col).alias("valid_from"), F.lit(0.0).alias("_net"))
    moves = (flows.filter(F.col(date_col) <= stop)
             .join(live.select(*on, start_col), on).filter(F.col(date_col) >= F.col(start_col))
             .select(*on, F.col(date_col).alias("valid_from"), F.col(amount).alias("_net")))
    changes = starts.unionByName(moves).groupBy(*on, "valid_from").agg(F.sum("_net").alias("net"))
    series = Window.partitionBy(*on).orderBy("valid_from")
    runs = changes.select("*", F.sum("net").over(series).alias(out),
                          F.coalesce(F.lead("valid_from").over(series), F.date_add(stop, 1)).alias("valid_to"))
    return runs.join(live.drop(start_col), on)


def expand_runs(runs: DataFrame, net: str = "net", date_col: str = "dt") -> DataFrame:
    """One row per day of each run; the net amount belongs to the run's first day."""
    days = F.sequence(F.col("valid_from"), F.date_sub("valid_to", 1), F.expr("INTERVAL 1 DAY"))
    daily = runs.withColumn(date_col, F.explode(days))
    return daily.withColumn(net, F.when(F.col(date_col) == F.col("valid_from"), F.col(net)).otherwise(F.lit(0.0))).drop(
        "valid_from", "valid_to")


def runs_at(runs: DataFrame, points: DataFrame, on: list[str], date_col: str = "dt") -> DataFrame:
    """``points`` (on, day, …) with the run that covers the day: a range join on change points, no days made."""
    right = runs.select(*(F.col(k).alias(f"_r_{k}") for k in on), "valid_from", "valid_to", "balance")
    match = (F.col(date_col) >= F.col("valid_from")) & (F.col(date_col) < F.col("valid_to"))
    for k in on:
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    return points.join(right, match, "left").drop(*(f"_r_{k}" for k in on), "valid_from", "valid_to")
