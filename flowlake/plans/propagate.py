"""Changes carried down the graph, however late they are.

A lookback window recomputes the last days and misses whatever arrives later.  Here
the rows that arrived say which groups they touch, each model computes exactly those
groups again from the whole log, and the groups it changed are what the next model
looks at:

* *grouped* models (statistics per period and chain; daily nets): the touched
  (period, chain, …) groups;
* *running* models (balances): every row of a touched series from its first touched
  day on, starting from the stored balance of the day before.

Groups are computed again, not corrected by differences, so a change that is carried
down twice gives the same tables.  Periods of a change become date ranges in the
scans (adjoining periods are merged, so there are at most half as many ranges as the
calendar has periods in between); the groups themselves stay a DataFrame and are
joined, whatever their number.

Logs only gain rows, or have rows replaced under their key and day: a group that has
lost all its rows keeps its old result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowlake.context import RunContext
from flowlake.operators.blocked import blocked_running_sum
from flowlake.operators.stats import period_start
from flowlake.plans import models as M
from flowlake.session import workspace_dir
from flowlake.sinks import delete_insert, write_table

UNITS = ("day", "week", "month")


def period_end(start: dt.date, unit: str) -> dt.date:
    """First day after the period that begins on ``start``."""
    if unit == "day":
        return start + dt.timedelta(days=1)
    if unit == "week":
        return start + dt.timedelta(days=7)
    if unit == "month":
        return (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    raise ValueError(f"unknown period unit {unit!r}; known: {UNITS}")


def period_ranges(starts: list[dt.date], unit: str) -> list[tuple[dt.date, dt.date]]:
    """[from, to) ranges that cover the periods; adjoining ones are one range."""
    out: list[tuple[dt.date, dt.date]] = []
    for start in sorted(set(starts)):
        end = period_end(start, unit)
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _start(date_col: str, unit: str) -> Column:
    return F.col(date_col) if unit == "day" else period_start(date_col, unit)


def touched_groups(changed: DataFrame, unit: str, keys: list[str], date_col: str = "dt") -> DataFrame:
    """Distinct (period, keys…) of the changed rows; rows without a date touch nothing."""
    period = _start(date_col, unit).alias("period")
    return changed.filter(F.col(date_col).isNotNull()).select(period, *keys).distinct()


def in_periods(groups: DataFrame, unit: str, date_col: str = "dt") -> Column:
    """The touched periods as ranges of ``date_col``: literals, so they reach partition and scan filters."""
    starts = [r["period"] for r in groups.select("period").distinct().collect()]
    ranges = [(F.col(date_col) >= F.lit(a)) & (F.col(date_col) < F.lit(b)) for a, b in period_ranges(starts, unit)]
    return reduce(Column.__or__, ranges, F.lit(False))


def rows_of(rows: DataFrame, groups: DataFrame, unit: str, keys: list[str], date_col: str = "dt") -> DataFrame:
    """The rows of the touched groups, all columns; keys match null-safe."""
    right = groups.select(F.col("period").alias("_g_period"), *(F.col(k).alias(f"_g_{k}") for k in keys))
    match = _start(date_col, unit) == F.col("_g_period")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return rows.filter(in_periods(groups, unit, date_col)).join(right, match, "left_semi")


def refresh_groups(spark: SparkSession, rows: DataFrame, changed: DataFrame, unit: str, keys: list[str],
                   build: Callable[[DataFrame], DataFrame], path: str, unique_key: list[str],
                   partition_by: list[str] | None = None, date_col: str = "dt") -> DataFrame:
    """Compute the touched groups again from ``rows`` (the whole log, changes included) and replace them.

    ``build`` maps whole groups to the model's rows, one per ``unique_key``.  Returns
    the touched groups, written, for the models that come after.
    """
    groups = write_table(spark, touched_groups(changed, unit, keys, date_col), workspace_dir(spark, "touched"))
    delete_insert(spark, build(rows_of(rows, groups, unit, keys, date_col)), path, unique_key, partition_by)
    return groups


def with_double(df: DataFrame, name: str) -> StructType:
    """The schema of ``df`` and one more column (adding to ``df.schema`` itself would change it)."""
    return StructType([*df.schema.fields, StructField(name, DoubleType())])


def refresh_running(spark: SparkSession, daily: DataFrame, changed: DataFrame, path: str, series: list[str],
                    value: str = "daily_net_amount", out: str = "balance", block: str = "month",
                    partition_by: list[str] | None = None) -> DataFrame:
    """Running sums of the touched series from their first touched day on.

    ``daily`` has one row per series and day without gaps (the spine sees to that),
    ``changed`` holds (dt, series…) of its changed rows.  The stored balance of the
    day before is where a series goes on; days before are neither read nor written.
    Returns (dt, series…) of the rows written.
    """
    first = changed.filter(F.col("dt").isNotNull()).groupBy(*series).agg(F.min("dt").alias("_from"))
    first = write_table(spark, first, workspace_dir(spark, "touched"))
    earliest = first.agg(F.min("_from").alias("d")).first()["d"]
    if earliest is None:
        return daily.select("dt", *series).limit(0)
    right = first.select("_from", *(F.col(k).alias(f"_g_{k}") for k in series))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in series))
    rows = daily.filter(F.col("dt") >= F.lit(earliest)).join(right, same & (F.col("dt") >= F.col("_from")), "left_semi")
    before = spark.read.schema(with_double(daily, out)).parquet(path)
    before = before.filter(F.col("dt") >= F.lit(earliest - dt.timedelta(days=1)))
    start = before.join(right, same & (F.col("dt") == F.date_sub("_from", 1)), "left_semi").select(*series, out)
    # the new rows are written before the table they start from is touched
    summed = blocked_running_sum(rows, series, "dt", value, out, block=block, start=start, start_col=out)
    batch = write_table(spark, summed.select(*daily.columns, out), workspace_dir(spark, "running"))
    delete_insert(spark, batch, path, ["dt", *series], partition_by)
    return batch.select("dt", *series)


def carry_tether_changes(spark: SparkSession, arrived: dict[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """Normalised transfers that arrived (by chain, of any age) into the tables of ``run_tether_models``.

    The rows replace those of the same key in their chain's table, then the weeks and
    months they touch are counted again.  Returns the written tables.
    """
    chains, changes, out = [], [], {}
    for chain, rows in arrived.items():
        path = f"{out_dir}/dbt_tether_{chain}"
        staged = write_table(spark, rows, workspace_dir(spark, "arrived"))
        out[f"dbt_tether_{chain}"] = delete_insert(spark, staged, path, ["dt", "tx_hash", "evt_index"], ["dt"])
        chains.append(out[f"dbt_tether_{chain}"])
        changes.append(staged.select("dt", "blockchain"))
    if not chains:
        return out
    log = reduce(DataFrame.unionByName, chains)
    changed = reduce(DataFrame.unionByName, changes)
    context = RunContext(as_of=dt.date.max)        # a full build of the touched groups: no window
    for unit, name in (("week", "fct_tether_weekly_stats"), ("month", "fct_tether_monthly_stats")):
        path = f"{out_dir}/{name}"
        refresh_groups(spark, log, changed, unit, ["blockchain"], lambda rows, u=unit: M.tether_stats([rows], u, context),
                       path, ["period", "blockchain"])
        out[name] = spark.read.parquet(path)
    return out
