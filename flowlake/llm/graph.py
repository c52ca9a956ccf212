"""Connected components of an edge table.

Every task first contracts the edges it holds to a forest (union-find), so one
task per EDGES_PER_TASK edges sees each edge once.  If there is more than one
such forest, alternating star contraction joins them: every node sends its
larger neighbours, then its smaller ones, to the smallest node it sees, and
paths shorten by half each round.  Each round is written to the shared folder,
so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import released, written

EDGES_PER_TASK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each node of this task's edges that is not the smallest of its tree, and that one."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a < b:
                above[b] = a
            elif b < a:
                above[a] = b
    rows = [(x, root(x)) for x in list(above)]
    rows = [(x, r) for x, r in rows if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges if not large else edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # in a small star a > b always, so "a" owns its smaller neighbours
    low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("c"), F.least("a", "low").alias("low"))
    joined = both.join(low, both["a"] == low["c"])
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select(F.col("c").alias("a"), F.col("low").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node reachable.

    ``edges`` has long columns a and b (give a written table: it is counted
    first); loops and repeats are ignored.
    """
    tasks = 1 + edges.count() // EDGES_PER_TASK
    now = written(edges.select("a", "b").coalesce(tasks).mapInArrow(released(_contract), "a long, b long"), name)
    seen = None
    while tasks > 1:
        now = written(_star(_star(now, True), False), name)
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
