"""Fingerprints and block-table search against direct computation."""

import hashlib
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

from flowlake.llm import simhash
from tests.llm.helpers import awkward_texts, documents, prose


def test_equal_texts_share_a_fingerprint_and_edits_stay_near():
    base = prose(4, 400)
    near = base.replace(base.split()[10], "changed", 1)
    a, b, c, d = simhash.fingerprints(pa.array([base, base.upper(), near, prose(5, 400, words=900)]))
    assert a == b
    assert simhash.likeness(a, c) > 0.85 > simhash.likeness(a, d)


def test_each_row_is_compared_with_its_successor(spark):
    texts = awkward_texts()
    ids = [i * 3 for i in range(len(texts))]
    ids[4] = None                       # sorts first
    ids[6] = ids[5]                     # tie: ordered by text
    docs = documents(spark, texts, ids).repartition(5)
    rows = simhash.with_next(docs).collect()
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode()))
    assert len(rows) == len(texts)
    left = list(rows)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        own, changed, following = simhash.fingerprints(pa.array([t, edited, after])).view(np.int64)
        want = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, changed, following)
        match = [r for r in left if tuple(r) == want]
        assert match, want
        left.remove(match[0])


def test_single_and_empty_tables(spark):
    one = simhash.with_next(documents(spark, ["alpha beta"], [7])).collect()
    assert one[0]["fp"] == one[0]["next_fp"]
    assert simhash.with_next(documents(spark).limit(0)).count() == 0


def test_search_finds_every_fingerprint_within_the_radius(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.integers(0, 2 ** 63, 20, dtype=np.uint64)
    points = [int(c) for c in centres]
    for c in centres:
        for flips in range(6):
            x = int(c)
            for bit in rnd.choice(64, flips, replace=False):
                x ^= 1 << int(bit)
            points += [x] * int(rnd.integers(1, 4))
    fps = np.array(points, np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    asked = spark.createDataFrame([(int(x),) for x in centres.view(np.int64)], "fp long")
    got = {r["fp"]: r["n_near"] for r in simhash.count_within(df, asked).collect()}
    for c in centres:
        assert got[int(np.int64(c))] == int((np.bitwise_count(fps ^ c) <= simhash.RADIUS).sum())


def test_search_names_the_documents_that_are_near(spark):
    rnd = np.random.default_rng(3)
    points = []
    for c in rnd.integers(0, 2 ** 63, 12, dtype=np.uint64):
        for flips in range(6):
            x = int(c)
            for bit in rnd.choice(64, flips, replace=False):
                x ^= 1 << int(bit)
            points += [x] * int(rnd.integers(1, 4))
    fps = np.array(points, np.uint64)
    docs = spark.createDataFrame([(i, int(x)) for i, x in enumerate(fps.view(np.int64))], "doc_id long, near_fp long")
    asked = spark.createDataFrame([(int(x),) for x in fps[::5].view(np.int64)], "fp long")
    pairs = simhash.find_within(docs.select(docs["near_fp"].alias("fp")), asked)
    rows = pairs.collect()
    assert len(rows) == len(set(rows))
    got = {(r["fp"], r["doc_id"]) for r in pairs.join(docs, "near_fp").collect()}
    assert got == {(int(q.view(np.int64)), i) for q in fps[::5] for i in np.flatnonzero(np.bitwise_count(fps ^ q) <= simhash.RADIUS)}
    counts = {r["fp"]: r["n_near"] for r in simhash.count_within(docs.select(docs["near_fp"].alias("fp")), asked).collect()}
    assert counts == {q: sum(1 for p, _ in got if p == q) for q, _ in got}


def test_a_crowd_of_near_fingerprints_is_searched_in_little_memory(spark):
    # all within two bits of one another: every pair of a tile is a hit
    bits = [1 << k for k in range(64)]
    fps = np.array([0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i])], np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").coalesce(1)
    got = {r["fp"]: r["n_near"] for r in simhash.count_within(df, df).collect()}
    for q in fps[::97]:
        assert got[int(q.view(np.int64))] == int((np.bitwise_count(fps ^ q) <= simhash.RADIUS).sum())
    x = np.zeros((simhash.TILE, simhash.TILE), np.uint64)
    tracemalloc.start()
    simhash._lowest_three(x.reshape(-1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_the_rows_are_kept_without_a_file_for_each_task(spark):
    before = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    files = set(Path(before.removeprefix("file:")).rglob("*.parquet"))
    assert simhash.with_next(documents(spark)).count() == len(awkward_texts())
    assert set(Path(before.removeprefix("file:")).rglob("*.parquet")) == files
