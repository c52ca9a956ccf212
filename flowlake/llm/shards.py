"""Shards of near-equal bytes by sampled splitters.

Rows are ordered by (hash of the text, id), so equal texts lie side by side:

1. *Sample*: a row is drawn with a chance in proportion to its size.  The draw is
   a hash of the key, so a repeated task draws the same rows.
2. *Splitters*: quantiles of the sample cut the order into ranges.  A group of
   equal texts is cut only if it alone is more than a range's share.
3. *Subdivision*: the exact bytes and rows of every range are counted.  Overfull
   ranges, and those across a shard's ideal border that are wider than TOLERANCE
   of a shard, are sampled again and cut finer, until none is left.
4. *Range partitioning*: each shard takes whole neighbouring ranges; rows move
   once, to the task of their range, and are numbered there (the place in the
   sorted task plus an offset known from the counts).

The driver holds the splitters and one (bytes, rows) pair per range: at most
MOST_RANGES and SAMPLE_PER_RANGE points each, however many rows there are.

Shards differ from the mean by TOLERANCE of a shard on each side, or by one row
where a single row is larger.

Defined cases: null text counts as empty (size 1); a null id comes before all
ids; rows equal in text and id cannot be told apart and stay together; empty
shards are possible where there are fewer rows than shards; an empty table gives
an empty folder with the schema; other columns are carried, but columns named
``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.common import kept

LAW = "bytes"
RANGES_PER_SHARD = 16
RANGE_BYTES = 256 << 20
MOST_RANGES = 16_384
SAMPLE_PER_RANGE = 32
TOLERANCE = 0.005            # of a shard's bytes, for each of its two borders
CUT_SAMPLE = 1024            # points drawn from a range that is cut finer
MOST_ROUNDS = 16
TASK_BYTES = 128 << 20
FIRST_ID = -(1 << 63)        # stands for a null id, and for the begin of a group


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; null counts as empty."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(FIRST_ID))


@dataclass
class Splitters:
    """Sorted, distinct (hash, id) pairs; range i holds the keys from splitter i - 1 to before splitter i."""
    keys: list[tuple[int, int]]

    def range_of(self, h: np.ndarray, i: np.ndarray) -> np.ndarray:
        if not self.keys:
            return np.zeros(len(h), np.int64)
        own = np.array(self.keys, np.int64)
        hashes, group = np.unique(own[:, 0], return_inverse=True)
        ids, rank = np.unique(own[:, 1], return_inverse=True)
        steps = len(ids) + 1
        marks = group.reshape(-1) * steps + rank.reshape(-1) + 1
        at = np.searchsorted(hashes, h)
        same = np.append(hashes, 0)[at] == h
        same &= at < len(hashes)
        place = at * steps + np.where(same, np.searchsorted(ids, i, side="right"), -1)
        return np.searchsorted(marks, place, side="right")

    def column(self, h: Column, i: Column) -> Column:
        @F.pandas_udf(T.IntegerType())
        def find(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series(self.range_of(x.to_numpy(np.int64), y.to_numpy(np.int64)), dtype="int32")

        return find(h, i)

    def ends(self, r: int) -> tuple[tuple[int, int] | None, tuple[int, int] | None]:
        return self.keys[r - 1] if r else None, self.keys[r] if r < len(self.keys) else None


def quantile_cuts(points: list[tuple[int, int, float]], n: int) -> list[tuple[int, int]]:
    """At most n - 1 splitters that cut weighted points (hash, id, weight) into near-equal parts.

    A splitter falls on the begin of a group of equal hashes, unless the group
    alone weighs more than a part; such a group is set apart and cut by ids.
    """
    if not points or n < 2:
        return []
    points = sorted(points)
    weight = np.array([w for _, _, w in points])
    h = np.array([p[0] for p in points], np.int64)
    upto = np.cumsum(weight)
    share = upto[-1] / n
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    group = np.add.reduceat(weight, first)
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    at = np.searchsorted(upto, share * np.arange(1, n), side="left")
    cuts = {(points[k][0], points[k][1] if group[of[k]] > share else FIRST_ID) for k in at.tolist() if k < len(points)}
    for g in np.flatnonzero(group > share).tolist():
        cuts.add((int(h[first[g]]), FIRST_ID))
        if g + 1 < len(first):
            cuts.add((int(h[first[g + 1]]), FIRST_ID))
    return sorted(cuts)


@dataclass
class Plan:
    splitters: Splitters
    size: np.ndarray         # exact bytes of each range
    rows: np.ndarray
    shard: np.ndarray        # shard of each range, ascending
    first_slot: np.ndarray   # place of the range's first row in its shard


def _draw(keys: DataFrame, rate: Column, salt: int) -> list[tuple[int, int, float]]:
    """Rows drawn with probability rate (1 at most), weighted by size over probability."""
    chance = F.least(rate, F.lit(1.0))
    uniform = F.shiftrightunsigned(F.xxhash64("h", "i", F.lit(salt)), 11) / float(1 << 53)
    drawn = keys.filter(uniform < chance).groupBy("h", "i").agg(F.sum(F.col("size") / chance).alias("w"))
    return [(r["h"], r["i"], r["w"]) for r in drawn.collect()]


def plan_shards(keys: DataFrame, n_shards: int) -> Plan:
    """Splitters and shards for the rows (h, i, size)."""
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    total, rows = total or 0, rows or 0
    wanted = min(max(RANGES_PER_SHARD * n_shards, -(-total // RANGE_BYTES)), MOST_RANGES)
    points = _draw(keys, F.col("size") * (SAMPLE_PER_RANGE * wanted / total), 0) if total else []
    splitters = Splitters(quantile_cuts(points, wanted))
    full = max(2 * total / wanted, 1)
    slack = max(TOLERANCE * total / n_shards, 1)
    settled: set = set()
    for turn in range(1, MOST_ROUNDS + 1):
        found = {r["r"]: (r["size"], r["rows"]) for r in keys.groupBy(splitters.column(F.col("h"), F.col("i")).alias("r")).agg(
            F.sum("size").alias("size"), F.count("*").alias("rows")).collect()}
        n = len(splitters.keys) + 1
        size = np.array([found.get(r, (0, 0))[0] for r in range(n)], np.int64)
        count = np.array([found.get(r, (0, 0))[1] for r in range(n)], np.int64)
        end = np.cumsum(size)
        ideal = total * np.arange(1, n_shards) / n_shards
        across = np.zeros(n, bool)
        across[np.minimum(np.searchsorted(end, ideal, side="left"), n - 1)] = True
        cut = [r for r in np.flatnonzero((count > 1) & ((size > full) | (across & (size > slack)))).tolist()
               if splitters.ends(r) not in settled]
        if not cut or turn == MOST_ROUNDS:
            break
        # all rows of a small range, else CUT_SAMPLE points of it
        rate = {r: 1.0 if count[r] <= CUT_SAMPLE else CUT_SAMPLE / float(size[r]) for r in cut}
        all_rows = {r for r in cut if count[r] <= CUT_SAMPLE}
        table = keys.sparkSession.createDataFrame(
            [(r, rate[r], r in all_rows) for r in cut], "r int, rate double, whole boolean")
        chosen = keys.withColumn("r", splitters.column(F.col("h"), F.col("i"))).join(F.broadcast(table), "r")
        points = _draw(chosen, F.when(F.col("whole"), F.lit(1.0)).otherwise(F.col("rate") * F.col("size")), turn)
        place = splitters.range_of(np.array([p[0] for p in points], np.int64), np.array([p[1] for p in points], np.int64))
        new = set(splitters.keys)
        for r in cut:
            own = [p for p, k in zip(points, place.tolist()) if k == r]
            parts = int(min(max(np.ceil(size[r] / (slack if across[r] else full / 2)), 2), CUT_SAMPLE))
            more = set(quantile_cuts(own, parts)) - new
            begin, stop = splitters.ends(r)
            more = {k for k in more if (begin is None or k > begin) and (stop is None or k < stop)}
            if not more and r in all_rows:
                settled.add((begin, stop))
            new |= more
        splitters = Splitters(sorted(new))
    # each shard ends with the range that ends nearest to the ideal border
    after = np.searchsorted(end, ideal, side="left")
    low = np.where(after > 0, np.append(end, 0)[after - 1], 0)
    nearer = (ideal - low) < (np.append(end, total)[after] - ideal)
    border = np.where(nearer, after, after + 1)
    shard = np.searchsorted(border, np.arange(n), side="right")
    before = np.cumsum(count) - count
    start = np.zeros(n_shards, np.int64)
    np.add.at(start, shard, count)
    start = np.cumsum(start) - start
    return Plan(splitters, size, count, shard, before - start[shard])


def placed(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """The rows with ``slot`` and ``shard`` in the tasks that write them, ascending by shard."""
    spark = docs.sparkSession
    # neighbouring ranges share a task up to TASK_BYTES; their number also keeps all cores busy
    total = int(plan.size.sum())
    tasks = max(1, min(len(plan.size), max(2 * spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))))
    task = np.minimum((np.cumsum(plan.size) - plan.size) * tasks // max(total, 1), tasks - 1)
    before = np.cumsum(plan.rows) - plan.rows
    begins = np.searchsorted(task, task, side="left")
    offset = plan.first_slot - (before - before[begins])
    ranges = spark.createDataFrame(
        list(zip(range(len(task)), task.tolist(), plan.shard.tolist(), offset.tolist())),
        "_range int, _task int, shard int, _offset long")
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = (docs.withColumn("_h", text_key(docs[text_col])).withColumn("_i", id_key(docs[id_col]))
            .withColumn("_range", plan.splitters.column(F.col("_h"), F.col("_i")))
            .join(F.broadcast(ranges), "_range")      # one row per range: MOST_RANGES and some
            # shards ascend with ranges: named first, the writer finds the rows in its order and sorts no second time
            .repartitionById(tasks, F.col("_task")).sortWithinPartitions("shard", "_range", "_h", "_i")
            .withColumn("slot", in_task + F.col("_offset")))
    return rows.select(*docs.columns, "slot", "shard")


def write_shards(docs: DataFrame, n_shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> Plan:
    """Write the rows with ``shard`` and ``slot`` into a folder per shard; returns the plan."""
    if n_shards < 1:
        raise ValueError("at least one shard")
    docs = docs.drop("shard", "slot")
    h, i = text_key(docs[text_col]), id_key(docs[id_col])
    keys = kept(docs.select(h.alias("h"), i.alias("i"), text_size(docs[text_col]).alias("size")))
    try:
        plan = plan_shards(keys, n_shards)
    finally:
        keys.unpersist()
    placed(docs, plan, id_col, text_col).write.partitionBy("shard").parquet(path)
    return plan


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all shards; ``schema`` is that of the documents."""
    kept = [f for f in schema.fields if f.name.lower() not in ("shard", "slot")]
    full = T.StructType([*kept, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(full).parquet(path)
