"""Distinct senders and receivers kept as tables that increments extend.

*Exact*: a table of first sightings (period, chain, role, address).  A batch adds
the addresses not yet seen in the periods it touches; counts are plain group
counts of the table.  Nothing is expanded for several distinct counts, and old
transfers are not read again.

*Approximate*: a table of one mergeable sketch per (day, chain, role).  A batch
replaces the sketches of its days; weeks, months or any other period are unions of
days.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators.stats import period_start
from flowlake.sinks import delete_insert, write_table
from flowlake.sinks.writers import table_exists

ROLES = (("sender", "from"), ("receiver", "to"))
SIGHTING_KEY = ["period", "blockchain", "role", "address"]


def roles(transfers: DataFrame, date_col: str = "dt", chain_col: str = "blockchain") -> DataFrame:
    """(dt, blockchain, role, address), one row per side of a transfer; NULL addresses are not counted."""
    sides = F.array(*(F.struct(F.lit(role).alias("role"), F.col(c).cast("string").alias("address")) for role, c in ROLES))
    return (transfers.select(F.col(date_col).alias("dt"), F.col(chain_col).alias("blockchain"), F.explode(sides).alias("side"))
            .select("dt", "blockchain", "side.role", "side.address").filter(F.col("address").isNotNull()))


def sightings(transfers: DataFrame, unit: str) -> DataFrame:
    """Distinct (period, blockchain, role, address); combined in each task before the shuffle."""
    return roles(transfers).select(period_start("dt", unit).alias("period"), "blockchain", "role", "address").distinct()


def add_sightings(spark: SparkSession, transfers: DataFrame, unit: str, path: str) -> DataFrame:
    """Add a batch to the table at ``path`` and return it; a repeated batch adds nothing.

    Only the periods that the batch touches are read (one partition filter value
    each); NULL chains match each other.
    """
    batch = sightings(transfers, unit)
    if not table_exists(spark, path):
        return write_table(spark, batch, path, ["period"])
    table = spark.read.schema(batch.schema).parquet(path)
    touched = [r["period"] for r in batch.select("period").distinct().collect()]
    known = table.filter(F.col("period").isin([p for p in touched if p is not None]) | F.col("period").isNull())
    known = known.select(*(F.col(k).alias(f"_k_{k}") for k in SIGHTING_KEY))
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in SIGHTING_KEY))
    batch.join(known, match, "left_anti").write.partitionBy("period").mode("append").parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def distinct_counts(seen: DataFrame) -> DataFrame:
    """(period, blockchain, senders, receivers): the table's rows counted."""
    counts = [F.count(F.when(F.col("role") == role, F.lit(1))).alias(f"{role}s") for role, _ in ROLES]
    return seen.groupBy("period", "blockchain").agg(*counts)


def lg_k(rsd: float) -> int:
    """Sketch size (log2 of registers) for a relative standard deviation of at most ``rsd``."""
    return min(max(math.ceil(2 * math.log2(1.04 / rsd)), 4), 21)


def daily_sketches(transfers: DataFrame, rsd: float = 0.01) -> DataFrame:
    """(month, dt, blockchain, role, sketch); a group's state is one sketch, whatever its rows."""
    daily = roles(transfers).groupBy("dt", "blockchain", "role").agg(F.hll_sketch_agg("address", lg_k(rsd)).alias("sketch"))
    return daily.select(F.trunc("dt", "month").alias("month"), "dt", "blockchain", "role", "sketch")


def store_sketches(spark: SparkSession, transfers: DataFrame, path: str, rsd: float = 0.01) -> DataFrame:
    """Replace the sketches of the days in ``transfers`` (whole days); other days are not read for it."""
    return delete_insert(spark, daily_sketches(transfers, rsd), path, ["month", "dt", "blockchain", "role"], ["month"],
                         null_keys="keep")


def sketched_counts(stored: DataFrame, unit: str) -> DataFrame:
    """(period, blockchain, senders, receivers) by union of the stored days."""
    merged = stored.groupBy(period_start("dt", unit).alias("period"), "blockchain").agg(
        *(F.hll_union_agg(F.when(F.col("role") == role, F.col("sketch"))).alias(role) for role, _ in ROLES))
    return merged.select("period", "blockchain",
                         *(F.coalesce(F.hll_sketch_estimate(role), F.lit(0)).alias(f"{role}s") for role, _ in ROLES))
