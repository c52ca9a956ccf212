"""MinHash near-duplicates by an LSH forest: sorted signature orders.

1. Each text becomes its set of k-word shingles and a signature of HASHES
   16-bit minima.  Equal sets collapse to one *node* first (grouped by digest,
   combined map-side), so thousands of copies cost one row.
2. Each of TREES orders sorts all nodes by the signature rotated to another
   start.  Candidates are neighbours in an order: rows whose longest common
   prefix is MIN_DEPTH or more.  Among many rows with that prefix the nearest
   ones share longer prefixes, so the depth grows where a region is crowded.
3. Links are confirmed on full shingle sets.  First the few closest neighbours
   per node are tested and contracted to components, then the most alike within
   NEAR places; third, every pair of an order within WINDOW places that still
   joins two components (within CROWD places if both are open, see 4).  In a crowd
   of near copies this spans the crowd without testing all its pairs.
4. A node is *open* if rows with its prefix go on past its window, or past a
   task border, in any order.  Pairs further apart than that have two open ends,
   and the open nodes are joined exactly: sets at the threshold share one of
   their rarest shingles (prefix filter, any fixed order of shingles will do).
   Shingles of one component only are left out, as are those whose sets all share
   the next rarer one.  Long lists are dealt to pairs of blocks of about BLOCK sets;
   each yields no more links than join its components.

A pair at the threshold 0.8 shares a prefix of 4 in one order with probability
0.41, so all 25 orders miss it with probability 2e-6.  A signature filter lets
pairs pass whose estimate is at most 5 standard deviations below the threshold
(a true link fails it with probability 3e-7).
The orders are range-partitioned by tree, prefix and node, so that a crowded
prefix spreads over tasks; a task keeps the last 2 * WINDOW rows only.

Full sets are rebuilt only for nodes in a pair that passed, chosen by a Bloom
filter of fixed size (BLOOM_BITS) whatever the number of documents.  Another one
keeps texts out of shuffles: a row stays where it is unless the filter holds its
id, and only the others are joined with the ids to drop.

Defined cases: null texts and texts without words have the empty set and link
with nothing; a text of fewer than k words is one shingle; rows with equal text
(also with equal or null doc_id) are in one component, whose id is its smallest
non-null doc_id; texts that occur under null ids only are linked with equal
texts only, and their component_id is null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import SMALL_CHUNK, chunk_rows, find_words, mix64, released, shingle_hashes, text_buffer, written
from flowlake.llm.graph import components

HASHES = 256
TREES = 25
ROTATE = 5                 # tree t starts at hash 5 t: the first five are its own
KEY_HASHES = 12            # length of a sort key, in hashes
MIN_DEPTH = 4
NEAR = 4                   # places looked at in round 2
WINDOW = 48                # and in round 3; what is further away is left to round 4
CROWD = 2 * NEAR           # and in round 3 between two nodes that round 4 compares anyway
SHORT_BITS = 2             # of each hash that a signed row carries: 64 bytes of 512
BLOCK = 256                # sets of one shingle compared at once in round 4
COUNT_BUCKETS = 1 << 22    # counts that order the shingles of round 4 (hashed: only its speed depends on them)
COLUMNS = 4096             # shingles per product of two blocks
CLOSEST = 3                # neighbours per node tested first
BLOOM_BITS = 1 << 23

_SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _ODD = _SEEDS[:HASHES], _SEEDS[HASHES:] | np.uint64(1)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Per chunk of texts: their sorted distinct shingle hashes, and signatures."""
    data, offsets = text_buffer(column)
    for lo, hi in chunk_rows(offsets, SMALL_CHUNK):
        h, bound = shingle_hashes(find_words(data, offsets[lo:hi + 1]), k)
        sets = [np.unique(h[a:b]) for a, b in zip(bound[:-1], bound[1:])]
        flat = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        signature = np.zeros((hi - lo, HASHES), ">u2")
        if len(full):
            start = (np.cumsum(sizes) - sizes)[full]
            for i in range(HASHES):
                low = np.minimum.reduceat((flat ^ _XOR[i]) * _ODD[i], start)
                signature[full, i] = (mix64(low) >> np.uint64(48)).astype(np.uint16)
        yield sets, signature


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, node (64 bits of the set's digest; null when empty), sig."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, sig = [], [], []
            for sets, signature in shingle_sets(batch.column("text"), k):
                n += [len(s) for s in sets]
                node += [int.from_bytes(_digest(s)[:8], "big", signed=True) if len(s) else None for s in sets]
                sig += [x.tobytes() if len(s) else None for s, x in zip(sets, signature)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "node", "sig"])

    return source.mapInArrow(released(run), "doc_id long, n_shingles long, node long, sig binary")


def _rows(column: pa.Array, dtype: str) -> np.ndarray:
    """A binary column of equally long values as a matrix, without an object per value."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view(dtype).reshape(n, -1)


def _short(sig: np.ndarray) -> np.ndarray:
    """The lowest SHORT_BITS bits of each hash, four to a byte."""
    low = (sig & 3).astype(np.uint8).reshape(len(sig), -1, 4)
    return low[:, :, 0] | low[:, :, 1] << 2 | low[:, :, 2] << 4 | low[:, :, 3] << 6


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of equal short hashes, row by row."""
    differ = x ^ y
    return 1 - np.bitwise_count((differ | differ >> 1) & np.uint8(0x55)).sum(axis=1, dtype=np.int64) / HASHES


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    data = np.ascontiguousarray(matrix)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


# ---------------------------------------------------------------- the forest

def _orders(nodes: DataFrame, signed: bool = False) -> DataFrame:
    """One row per node and tree, in tree and prefix order. nodes: node, sig, root.

    ``signed`` rows carry the low bits of each hash, to judge pairs in place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _rows(batch.column("sig"), ">u2")
            short = _binary(_short(sig)) if signed else pa.nulls(len(sig), pa.binary())
            turned = np.concatenate([sig, sig[:, :KEY_HASHES]], axis=1)
            for t in range(TREES):
                keys = _binary(turned[:, t * ROTATE:t * ROTATE + KEY_HASHES])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sig), t, np.int32)), keys, batch.column("node"), batch.column("root"), short],
                    ["tree", "key", "node", "root", "short"])

    rows = nodes.select("node", "sig", "root").mapInArrow(released(run), "tree int, key binary, node long, root long, short binary")
    return rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")


def _neighbours(orders: DataFrame, window: int, least: float | None = None, mark: bool = False) -> DataFrame:
    """Pairs (a < b) of different roots within ``window`` places whose common prefix is MIN_DEPTH or more.

    With ``least`` (signed orders) only pairs whose short signatures agree so far.
    With ``mark`` also a row a = b for each node whose prefix goes on past its
    window or may go on past the border of its task.  Two such nodes are paired
    within CROWD places only: round 4 compares them whatever their places, so that a
    crowd of any size makes CROWD pairs a row at most, and not ``window``.
    """

    def marks(ids: np.ndarray) -> pa.RecordBatch:
        ids = np.unique(ids)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(np.zeros(len(ids), np.int32)), pa.array(np.zeros(len(ids)))],
                                          ["a", "b", "depth", "alike"])

    def joined(tree: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Common prefix of each row and the next."""
        same = (key[1:] == key[:-1]).cumprod(axis=1).sum(axis=1)
        return np.where(tree[1:] == tree[:-1], same, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, key = np.zeros(0, np.int32), np.zeros((0, KEY_HASHES), np.uint16)
        node, root, opened = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        short = np.zeros((0, HASHES * SHORT_BITS // 8), np.uint8)
        first = 0 if mark else window              # rows so far of the run at the task's lower border
        due = 0                                    # the rows from here on are not paired yet
        for batch in chain(batches, [None]):
            if batch is not None:
                if not batch.num_rows:
                    continue
                old = len(node)
                fresh = _rows(batch.column("key"), ">u2")
                tree = np.concatenate([tree, batch.column("tree").to_numpy()])
                key = np.concatenate([key, fresh])
                node = np.concatenate([node, batch.column("node").to_numpy()])
                root = np.concatenate([root, batch.column("root").to_numpy()])
                opened = np.concatenate([opened, np.zeros(len(fresh), bool)])
                if least is not None:
                    short = np.concatenate([short, _rows(batch.column("short"), np.uint8)])
            if not len(node):
                continue
            depth, stop = joined(tree, key), len(node)
            if mark:
                # marks come before pairs: a row is paired when the rows of its window have been seen
                missed = np.append(0, np.cumsum(depth < MIN_DEPTH))
                full = np.flatnonzero(missed[window:] == missed[:-window])
                ends = [full, full + window]
                if batch is None:
                    tail = np.logical_and.accumulate(np.append(True, depth[::-1] >= MIN_DEPTH))[::-1]
                    ends.append(np.flatnonzero(tail)[-window:])
                else:
                    stop = max(stop - window, due)
                    if first < window:
                        head = np.logical_and.accumulate(np.append(old == 0, depth >= MIN_DEPTH)[old:])
                        ends.append(old + np.flatnonzero(head)[:window - first])
                        first = first + len(head) if head.all() else window
                at = np.unique(np.concatenate(ends))
                at = at[~opened[at]]
                opened[at] = True
                yield marks(node[at])
            low = depth[:max(stop - 1, 0)]
            for j in range(1, min(window, stop - 1) + 1):
                if j > 1:
                    low = np.minimum(low[:-1], depth[j - 1:stop - 1])
                later = np.arange(j, stop)
                hit = (low >= MIN_DEPTH) & (later >= due) & (root[j:stop] != root[:stop - j])
                if j > CROWD:
                    hit &= ~(opened[j:stop] & opened[:stop - j])
                hit = np.flatnonzero(hit)
                alike = np.ones(len(hit))
                if least is not None and len(hit):
                    alike = _agreement(short[hit], short[hit + j])
                    hit, alike = hit[alike >= least], alike[alike >= least]
                if len(hit):
                    x, y = node[hit], node[hit + j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(low[hit].astype(np.int32)), pa.array(alike)],
                        ["a", "b", "depth", "alike"])
            begin = max(stop - window, 0)
            tree, key, node, root, short, opened = (x[begin:] for x in (tree, key, node, root, short, opened))
            due = stop - begin

    return orders.mapInArrow(released(run), "a long, b long, depth int, alike double")


def _best(pairs: DataFrame, *order: str) -> DataFrame:
    """The CLOSEST pairs of each node by the given columns, descending (the rest is tested later)."""
    rank = F.row_number().over(Window.partitionBy("b").orderBy(*(F.desc(c) for c in order), "a"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= CLOSEST).select("a", "b")


# ---------------------------------------------------------------- confirming

def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures do not rule the threshold out."""
    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_rows(batch.column(c), np.uint16) for c in ("sig_a", "sig_b"))
            keep = (x == y).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"])

    return joined.mapInArrow(released(run), "a long, b long")


def _bloom(ids: DataFrame) -> np.ndarray:
    """A fixed-size bit table of the ids' hashes (one per task reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            bits[_bit(batch.column(0).to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    total = np.zeros(BLOOM_BITS // 8, np.uint8)
    for row in ids.coalesce(8).mapInArrow(released(run), "bits binary").collect():
        total |= np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(total).astype(bool)


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64)) % np.uint64(BLOOM_BITS)).astype(np.int64)


def _perhaps(ids: DataFrame) -> Callable[[Column], Column]:
    """A test of long columns: false only for values that ``ids`` does not hold; true for null."""
    bits = ids.sparkSession.sparkContext.broadcast(np.packbits(_bloom(ids.filter(F.col(ids.columns[0]).isNotNull()))))

    @F.arrow_udf("boolean")
    def held(values: pa.Array) -> pa.Array:
        at = _bit(values.fill_null(0).to_numpy())
        return pa.array((bits.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool) | values.is_null().to_numpy(zero_copy_only=False))

    return held


def _sets(wanted: DataFrame, docs: DataFrame, firsts: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(node, members): the full sets of the nodes wanted.

    firsts: node → doc_id of one document that has the set.
    """
    ids = firsts.join(wanted, "node", "left_semi").select("first")
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(_bloom(ids)))
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).filter("doc_id is not null")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted_bits = np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(wanted_bits[_bit(batch.column("doc_id").to_numpy())]))
            if not batch.num_rows:
                continue
            sets = []
            data, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunk_rows(offsets, SMALL_CHUNK):
                h, bound = shingle_hashes(find_words(data, offsets[lo:hi + 1]), k)
                sets += [np.unique(h[a:b]) for a, b in zip(bound[:-1], bound[1:])]
            node = [int.from_bytes(_digest(s)[:8], "big", signed=True) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(node, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["doc_id", "node", "members"])

    sets = source.mapInArrow(released(build), "doc_id long, node long, members binary")
    # one document stands for each node: keep exactly that row
    return (sets.join(firsts.select(F.col("first").alias("doc_id"), "node"), ["doc_id", "node"])
            .dropDuplicates(["node"]).select("node", "members"))


def _confirmed(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, k: int, percent: int,
               id_col: str, text_col: str) -> DataFrame:
    """Pairs of nodes with 100 * |x & y| >= percent * |x | y| on full sets."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(wanted, docs, firsts, k, id_col, text_col)
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return joined.mapInArrow(released(test), "a long, b long")


# ---------------------------------------------------------------- open nodes

def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix64(h) % np.uint64(COUNT_BUCKETS)).astype(np.int32)


def _members(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _counts(sets: DataFrame) -> np.ndarray:
    """Sets per bucket of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, n = np.unique(_bucket(np.concatenate(_members(batch.column("members")))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    found = sets.mapInArrow(released(run), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()
    counts = np.ones(COUNT_BUCKETS, np.int64)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return counts


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, root, rarer): so many of each set's rarest shingles that sets at the threshold share one.

    rarer is the set's next rarer shingle (the node for its rarest one): sets that
    share it too are compared there.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            node, root = batch.column("node").to_numpy(), batch.column("root").to_numpy()
            chosen, before = [], []
            for own, x in zip(node, _members(batch.column("members"))):
                least = -(-percent * len(x) // 100)
                x = x[np.lexsort((x, counts[_bucket(x)]))[:len(x) - least + 1]].view(np.int64)
                chosen.append(x)
                before.append(np.append(own, x[:-1]))
            sizes = [len(x) for x in chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(chosen)), pa.array(np.repeat(node, sizes)), pa.array(np.repeat(root, sizes)), pa.array(np.concatenate(before))],
                ["token", "node", "root", "rarer"])

    return sets.select("node", "root", "members").mapInArrow(released(run), "token long, node long, root long, rarer long")


def _dealt(rarest: DataFrame) -> DataFrame:
    """(token, lo, hi, block, node, root): the sets of each shingle in pairs of blocks that have something to compare."""
    several = (rarest.groupBy("token").agg(F.count("*").alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"),
                                           F.min("rarer").alias("p0"), F.max("rarer").alias("p1"))
               .filter("r0 <> r1 and p0 <> p1").select("token", "n"))
    lists = written(rarest.join(several, "token"), "lists")
    long = lists.filter(F.col("n") > BLOCK)

    def usual(c: str) -> DataFrame:
        """The most common value of a column in each long list."""
        return long.groupBy("token", c).agg(F.count("*").alias("times")).groupBy("token").agg(F.max_by(c, "times").alias(f"usual_{c}"))

    # kind: bit 2 for the most common root, bit 1 for the most common rarer shingle; a bit in common: nothing to compare
    lists = (lists.join(usual("root"), "token", "left").join(usual("rarer"), "token", "left")
             .withColumn("kind", F.when(F.col("n") <= BLOCK, 0).otherwise(
                 2 * (F.col("root") == F.col("usual_root")).cast("int") + (F.col("rarer") == F.col("usual_rarer")).cast("int")))
             .select("token", "node", "root", "kind"))
    lists = written(lists, "kinds")
    blocks = lists.groupBy("token").agg(*(F.ceil(F.count(F.when(F.col("kind") == c, 1)) / BLOCK).cast("int").alias(f"b{c}") for c in range(4)))
    start = [F.lit(0), F.col("b0"), F.col("b0") + F.col("b1"), F.col("b0") + F.col("b1") + F.col("b2")]
    own, others = F.lit(0), F.array().cast("array<int>")
    for c in range(4):
        size = F.col(f"b{c}")
        own = F.when(F.col("kind") == c, start[c] + F.pmod(F.xxhash64("node"), F.greatest(size, F.lit(1))).cast("int")).otherwise(own)
        fits = (size > 0) & (F.col("kind").bitwiseAND(F.lit(c)) == 0)
        others = F.concat(others, F.when(fits, F.sequence(start[c], start[c] + size - 1)).otherwise(F.array().cast("array<int>")))
    return (lists.join(blocks, "token").select("token", "node", "root", own.alias("block"), F.explode(others).alias("other"))
            .select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "root"))


def _shared(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all x with all y."""
    flat_x, flat_y = np.concatenate(xs), np.concatenate(ys)
    row_x, row_y = (np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (xs, ys))
    both = np.intersect1d(flat_x, flat_y)
    out = np.zeros((len(xs), len(ys)), np.float32)
    if not len(both):
        return out

    def entries(flat: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        hit = both[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], row[hit][order]

    (cx, rx), (cy, ry) = entries(flat_x, row_x), entries(flat_y, row_y)
    for lo in range(0, len(both), COLUMNS):
        x, y = (np.zeros((n, min(COLUMNS, len(both) - lo)), np.float32) for n in out.shape)
        for matrix, column, row in ((x, cx, rx), (y, cy, ry)):
            a, b = np.searchsorted(column, [lo, lo + COLUMNS])
            matrix[row[a:b], column[a:b] - lo] = 1
        out += x @ y.T
    return out


def _joining(node: np.ndarray, root: np.ndarray, block: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the two blocks of one group, as many as join components."""
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    size = np.array([len(s) for s in sets], np.int64)
    both = _shared([sets[i] for i in left], [sets[i] for i in right]).astype(np.int64)
    near = 100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)
    near &= root[left][:, None] != root[right][None, :]
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    out = []
    for i, j in np.argwhere(near):
        i, j = left[i], right[j]
        x, y = top(int(root[i])), top(int(root[j]))
        if x != y:
            above[x] = y
            out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
    return out


def _far_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links that join all components with a link between them. sets: node, root, members."""
    dealt = _dealt(written(_rarest(sets, percent), "rarest"))
    rows = dealt.join(sets.select("node", "members"), "node").select("token", "lo", "hi", "block", "node", "root", "members")
    rows = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts = None, []

        def links() -> pa.RecordBatch:
            node, root, block = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("node", "root", "block"))
            # one block with itself, or two; a pair of blocks with one side empty has nothing to compare
            found = [] if group[1] != group[2] and block.min() == block.max() else _joining(
                node, root, block, [x for p in parts for x in _members(p.column("members"))], percent)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "lo", "hi")])
            starts = np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                now = tuple(keys[:, a].tolist())
                if now != group and parts:
                    yield links()
                    parts = []
                group = now
                parts.append(batch.slice(a, b - a))
        if parts:
            yield links()

    return rows.mapInArrow(released(run), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    every = written(signatures(docs, k, id_col, text_col), "signatures")
    nodes = every.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.any_value("sig").alias("sig"))
    nodes = written(nodes, "nodes")
    firsts = nodes.filter("first is not null").select("node", "first")
    def floor(p: float) -> float:
        """Five standard deviations below the threshold's share of equal hashes."""
        return p - 5 * (p * (1 - p) / HASHES) ** 0.5

    threshold = percent / 100

    # round 1: the closest neighbours of each node in any order
    beside = _neighbours(_orders(nodes.select("node", "sig", F.col("node").alias("root"))), 1)
    beside = written(beside.groupBy("a", "b").agg(F.count("*").alias("times"), F.max("depth").alias("depth")), "beside")
    crowd = written(beside.select(F.col("a").alias("node")).union(beside.select(F.col("b").alias("node"))).distinct(), "beside-nodes")
    crowd = nodes.select("node", "sig").filter(_perhaps(crowd)(F.col("node"))).join(crowd, "node", "left_semi")
    crowd = written(crowd, "crowd")
    closest = written(_alike(_best(beside, "times", "depth"), crowd, floor(threshold)), "closest")
    links = written(_confirmed(closest, docs, firsts, k, percent, id_col, text_col), "links")
    roots = components(links)

    # round 2: the most alike of near places, between components; round 3: all of a wide window, and the open nodes
    alike = floor(threshold + (1 - threshold) / 2 ** SHORT_BITS)
    for window in (NEAR, WINDOW):
        rest = crowd.join(roots, "node", "left").select("node", "sig", F.coalesce("root", "node").alias("root"))
        within = _neighbours(_orders(written(rest, "rest"), signed=True), window, alike, mark=window == WINDOW)
        within = within.groupBy("a", "b").agg(F.max("alike").alias("alike"))
        if window == NEAR:
            within = _best(within, "alike")
        within = written(within.select("a", "b"), "within")
        more = _confirmed(within.filter("a <> b"), docs, firsts, k, percent, id_col, text_col)
        links = written(links.union(more), "links")
        roots = components(links)

    # round 4: open nodes against each other
    far = within.filter("a = b").select(F.col("a").alias("node"))
    sets = _sets(far, docs, firsts, k, id_col, text_col).join(roots, "node", "left")
    sets = written(sets.select("node", F.coalesce("root", "node").alias("root"), "members"), "open")
    links = written(links.union(_far_links(sets, percent)), "links")
    roots = components(links)

    # back to documents: the smallest doc_id of a component names it
    named = (nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = named.join(lowest, "root").select("node", "component_id")
    out = every.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id").eqNullSafe(component)).alias("kept"))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with its smallest doc_id.

    All columns stay.  Rows with the empty set are all kept.  Of rows that share a
    kept doc_id and the text one stays; rows that share the doc_id with another
    text stay with it.  Rows without a doc_id are only compared by equal text.
    """
    found = near_duplicates(docs, k, percent, id_col, text_col)
    found = written(found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("kept").alias("kept"), F.max("n_shingles").alias("most")), "kept")
    own = docs[id_col].cast("long")
    # most ids have one row, which stays: their rows, texts and all, need no shuffle
    doubtful = _perhaps(found.filter("not kept or (n > 1 and most > 0)").select("doc_id"))(own)
    keep = found.filter("kept").select(F.col("doc_id").alias("_id"))
    plain = docs.filter(~doubtful)
    rows = docs.filter(doubtful).join(keep, own.eqNullSafe(keep["_id"]), "left_semi")
    repeated = found.filter("kept and n > 1 and most > 0").select(F.col("doc_id").alias("_id"))
    if repeated.isEmpty():
        return plain.unionByName(rows)
    single = rows.join(repeated, own.eqNullSafe(repeated["_id"]), "left_anti")
    several = rows.join(repeated, own.eqNullSafe(repeated["_id"]), "left_semi")
    return plain.unionByName(single).unionByName(several.dropDuplicates([id_col, text_col]))
