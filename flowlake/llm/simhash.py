"""Document fingerprints: SimHash, and permuted block tables to search them.

Terms are two-word shingles weighted by 1 + ln(count) (in sixteenths, so that
sums are exact in any order); each term's 64-bit hash votes with its weight for
or against every bit, and the sign of the sum is the fingerprint's bit.
Likeness is the share of equal bits.

Search within RADIUS = 3 bits: 64 bits are cut into six blocks, and two
fingerprints that differ in three bits agree on at least three whole blocks.
There is one table per choice of three blocks (20); its key is those blocks.
Both sides are dealt out by (table, key); a task compares the queries of a key
with the fingerprints of that key, block by block in numpy, and sends only one
partial count per query.  A pair that agrees on more blocks counts in the table
of its lowest three.  ``find_within`` gives the matches themselves, as pairs of
distinct fingerprints; joined with the documents' fingerprints on near_fp they
name the documents.

``with_next`` compares each document with its successor by doc_id: one range
partitioning, a streaming pass, and the last row of each partition is finished
with the first row of the next non-empty one.

Defined cases: null text is empty; a text without words has fingerprint 0; a
null doc_id sorts first; rows with equal doc_id are ordered by text; a single
document is its own successor; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import chunk_rows, find_words, kept, shingle_hashes, text_buffer

TERM_WORDS = 2
RADIUS = 3
BITS = 64
# block borders: four blocks of 11 bits and two of 10
BORDERS = (0, 11, 22, 33, 44, 54, 64)
MASKS = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(BORDERS, BORDERS[1:])]
TABLES = list(combinations(range(6), 3))
TILE = 512                     # queries and fingerprints compared at once, so many of each


def fingerprints(column: pa.Array) -> np.ndarray:
    """uint64 fingerprints of the texts of a column."""
    out = []
    data, offsets = text_buffer(column)
    for lo, hi in chunk_rows(offsets):
        h, bound = shingle_hashes(find_words(data, offsets[lo:hi + 1]), TERM_WORDS)
        for a, b in zip(bound[:-1], bound[1:]):
            terms, count = np.unique(h[a:b], return_counts=True)
            weight = np.rint(16 * (1 + np.log(count)))
            votes = np.zeros(BITS)
            for k in range(0, len(terms), 1 << 14):      # long texts a part at a time
                part = terms[k:k + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
                votes += weight[k:k + (1 << 14)] @ np.unpackbits(part, axis=1).astype(np.float64)
            out.append(np.packbits(2 * votes > weight.sum()).view(">u8")[0])
    return np.array(out, np.uint64)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 1.0 - np.bitwise_count(x ^ y) / BITS


def edit(text: str, other: str) -> str:
    """The last half (rounded down) of ``text`` replaced by as much of ``other``'s start."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


_ROW = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fp": pa.int64(),
        "edited_fp": pa.int64(), "next_fp": pa.int64()}
_SQL = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long"


def _rows(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    edited = [edit(t, n) for t, n in zip(texts, following)]
    own, changed, after = (fingerprints(pa.array(x, pa.string())).view(np.int64) for x in (texts, edited, following))
    values = (ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited], own, changed, after)
    return [pa.array(v, t) for v, t in zip(values, _ROW.values())]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp of every row."""
    source = (docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
              .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    names = [*_ROW, "part", "head", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, held = TaskContext.get().partitionId(), None, None

        def border(doc_id, first, last) -> pa.RecordBatch:
            columns = [pa.array([doc_id], pa.int64()), *(pa.nulls(1, t) for t in list(_ROW.values())[1:]),
                       pa.array([part], pa.int32()), pa.array([first], pa.string()), pa.array([last], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            all_ids, all_texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo in range(0, len(all_ids), 512):
                ids, texts = all_ids[lo:lo + 512], all_texts[lo:lo + 512]
                if head is None:
                    head = texts[0]
                if held is not None:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                held = ids[-1], texts[-1]
                if len(ids) > 1:
                    n = len(ids) - 1
                    columns = _rows(ids[:-1], texts[:-1], texts[1:])
                    yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)
        if held is not None:
            yield border(held[0], head, held[1])

    out = kept(source.mapInArrow(run, _SQL + ", part int, head string, tail string"))
    # one row per non-empty partition: join its last row with the next one's first
    borders = out.filter("part is not null").select("part", "doc_id", "head", "tail")
    following = (borders.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))
                 .withColumn("first", F.min("part").over(Window.partitionBy()))
                 .select("part", F.coalesce("next", "first").alias("next")))
    ends = (borders.select("part", "doc_id", "tail").join(following, "part")
            .join(borders.select(F.col("part").alias("next"), "head"), "next").select("doc_id", "tail", "head"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_rows(*(batch.column(c).to_pylist() for c in ("doc_id", "tail", "head"))), list(_ROW))

    return out.filter("part is null").select(*_ROW).union(ends.mapInArrow(finish, _SQL))


# ---------------------------------------------------------------- search

def _lowest_three(x: np.ndarray) -> np.ndarray:
    """Bit masks of the three lowest blocks in which x is 0."""
    out, found = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for b, m in enumerate(MASKS):
        same = ((x & np.uint64(m)) == 0) & (found < 3)
        out |= same.astype(np.uint8) << np.uint8(b)
        found += same
    return out


def count_within(points: DataFrame, queries: DataFrame) -> DataFrame:
    """(fp, n_near): for each fingerprint of ``queries`` the rows of ``points`` within RADIUS bits.

    Both have a long column fp; equal fingerprints are counted once first.
    """
    return _search(points, queries, False).groupBy("fp").agg(F.sum("n").alias("n_near"))


def find_within(points: DataFrame, queries: DataFrame) -> DataFrame:
    """(fp, near_fp): each distinct fingerprint of ``points`` within RADIUS bits of one of ``queries``, once.

    A queried fingerprint that is among the points is near itself.
    """
    return _search(points, queries, True).withColumnRenamed("n", "near_fp")


def _search(points: DataFrame, queries: DataFrame, pairs: bool) -> DataFrame:
    """(fp, n) by block tables: partial counts of rows near a query, or with ``pairs`` the fingerprints near it."""
    have = points.groupBy("fp").agg(F.count("*").alias("n")).withColumn("asked", F.lit(False))
    asked = queries.select("fp").distinct().withColumn("n", F.lit(0).cast("long")).withColumn("asked", F.lit(True))
    keyed = have.union(asked).withColumn("key", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(sum(MASKS[b] for b in blocks)))).alias("k"))
        for t, blocks in enumerate(TABLES)])))
    dealt = (keyed.select("key.t", "key.k", "fp", "n", "asked").repartition("t", "k")
             .sortWithinPartitions("t", "k", F.desc("asked")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked_fp, at, near = np.zeros(0, np.uint64), None, np.zeros(0, np.int64)

        def done() -> pa.RecordBatch:
            hit = near > 0
            return pa.RecordBatch.from_arrays([pa.array(asked_fp[hit].view(np.int64)), pa.array(near[hit])], ["fp", "n"])

        for batch in batches:
            t, k, n = (batch.column(c).to_numpy() for c in ("t", "k", "n"))
            fp = batch.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            is_query = batch.column("asked").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(t) != 0) | (np.diff(k) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(t)]):
                if lo == hi:
                    continue
                if (t[lo], k[lo]) != at:
                    if near.any():
                        yield done()
                    at, asked_fp, near = (t[lo], k[lo]), np.zeros(0, np.uint64), np.zeros(0, np.int64)
                own = is_query[lo:hi]
                if own.any():
                    asked_fp = np.concatenate([asked_fp, fp[lo:hi][own]])
                    near = np.concatenate([near, np.zeros(own.sum(), np.int64)])
                if not len(asked_fp) or own.all():
                    continue
                mine = sum(1 << b for b in TABLES[t[lo]])
                points_fp, weight = fp[lo:hi][~own], n[lo:hi][~own]
                for a in range(0, len(asked_fp), TILE):
                    for b in range(0, len(points_fp), TILE):
                        x = asked_fp[a:a + TILE, None] ^ points_fp[None, b:b + TILE]
                        i, j = np.nonzero(np.bitwise_count(x) <= RADIUS)
                        good = _lowest_three(x[i, j]) == mine
                        i, j = i[good], j[good]
                        if not len(i):
                            continue
                        if pairs:
                            yield pa.RecordBatch.from_arrays([pa.array(asked_fp[a + i].view(np.int64)),
                                                              pa.array(points_fp[b + j].view(np.int64))], ["fp", "n"])
                            continue
                        near[a:a + TILE] += np.bincount(i, weights=weight[b + j], minlength=len(x)).astype(np.int64)
        if near.any():
            yield done()

    return dealt.mapInArrow(run, "fp long, n long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x
