"""Components against all pairs; crowds, copies and awkward rows."""

import random

import numpy as np
import pytest

from flowlake.llm import graph, neardup
from tests.llm.helpers import awkward_texts, documents, prose


def brute(texts, ids, k, percent):
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group] if group[i] != group[j] else group
    low = {}
    for g, i in zip(group, ids):
        low[g] = min(low.get(g, i), i)
    return {i: (len(s), low[g], low[g] == i) for i, s, g in zip(ids, sets, group)}


def copies(seed, n, words, edits):
    rnd = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_components_equal_all_pairs(spark):
    texts = awkward_texts()[:-1] + copies(11, 60, 120, 8) + copies(12, 30, 60, 4) + copies(13, 5, 8, 1)
    texts += [prose(100 + i, 80) for i in range(20)] + ["Same TEXT twice here now"] * 3 + ["same text twice here now"]
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup.near_duplicates(documents(spark, texts, ids), k=4).collect()}
    assert got == brute(texts, ids, 4, 80)


def test_repeated_and_null_ids(spark):
    texts = [prose(1, 50), prose(1, 50), prose(1, 50), None, None, prose(2, 50), prose(3, 50), prose(3, 50)]
    ids = [5, 5, None, 7, 7, None, 9, 8]
    docs = documents(spark, texts, ids)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (-1, 5), (5, 5), (5, 5), (7, 7), (7, 7), (8, 8), (9, 8)]
    left = neardup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted((r["doc_id"] or -1) for r in left.collect())
    assert kept.count(5) == 1 and kept.count(7) == 2 and kept.count(8) == 1 and kept.count(9) == 0


def test_empty_table(spark):
    assert neardup.near_duplicates(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("per_task", [500_000, 9])
def test_components_of_long_paths(spark, monkeypatch, per_task):
    monkeypatch.setattr(graph, "EDGES_PER_TASK", per_task)       # 9: several forests, joined by stars
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 101 + i) for i in range(5)] + [(7, 7), (60, 59)]
    random.Random(3).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(6)}}
    assert graph.components(df.limit(0)).count() == 0


def test_regions_far_larger_than_the_window(spark):
    """Texts with a shared passage (similarity 0.6) and pairs at 0.8 among them; a crowd of near copies with loose ends."""
    rnd = random.Random(5)
    passage = prose(70, 75).split()
    texts = [" ".join(passage + [f"own{i}x{j}" for j in range(28)]) for i in range(1200)]
    for i in range(0, 120):
        w = texts[10 * i].split()
        at = 80 + i % 3
        texts.append(" ".join(w[:at] + [f"new{i}x{j}" for j in range(len(w) - at - 13)] + w[-13:]))
    crowd = prose(71, 100).split()
    for i in range(400):
        w = list(crowd)
        for _ in range(rnd.randint(1, 4)):
            w[rnd.randrange(len(w))] = f"edit{i}x{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    want = brute(texts, ids, 4, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup.near_duplicates(documents(spark, texts, ids, extra=False), k=4).collect()}
    assert got == want


def test_open_nodes_are_joined_exactly(spark, monkeypatch):
    """All nodes open, long lists in many blocks: the same links' components as all pairs."""
    monkeypatch.setattr(neardup, "WINDOW", 1)
    monkeypatch.setattr(neardup, "NEAR", 1)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    texts = copies(21, 80, 60, 12) + copies(22, 40, 60, 9) + [prose(300 + i, 60) for i in range(5)]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in neardup.near_duplicates(documents(spark, texts, ids), k=4).collect()}
    assert got == brute(texts, ids, 4, 80)


def places(runs, seed=0):
    """Rows of one order, in runs of equal prefixes: run of a node, and the rows (tree, key, node, root, short)."""
    rnd = np.random.default_rng(seed)
    of = np.repeat(np.arange(len(runs)), runs)
    keys = rnd.integers(0, 1 << 16, (len(of), neardup.KEY_HASHES)).astype(">u2")
    keys[:, 0], keys[:, 1:neardup.MIN_DEPTH] = of + 1, 7
    keys = keys[np.lexsort(keys.T[::-1])]
    short = bytes(neardup.HASHES * neardup.SHORT_BITS // 8)
    return of.tolist(), [(0, bytearray(k.tobytes()), n, n, bytearray(short)) for n, k in enumerate(keys)]


@pytest.mark.parametrize("tasks", [1, 3])
def test_crowds_make_few_rows_and_lose_no_pair(spark, tasks):
    """A pair with a common prefix is given, or round 4 has both its nodes; the rows grow with a crowd, not with its window."""
    runs = [1, 30, 49, 60, 97, 1500, 2, 48, 700]
    of, rows = places(runs)
    orders = spark.createDataFrame(rows, "tree int, key binary, node long, root long, short binary")
    cut = -(-len(rows) // tasks)
    orders = orders.repartitionById(tasks, (orders["node"] / cut).cast("int")).sortWithinPartitions("tree", "key", "node")
    got = neardup._neighbours(orders, neardup.WINDOW, 0.5, mark=True).collect()
    pairs = {(r["a"], r["b"]) for r in got if r["a"] != r["b"]}
    opened = {r["a"] for r in got if r["a"] == r["b"]}
    first = np.append(0, np.cumsum(runs))
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        for a in range(lo, hi):
            assert all((a, b) in pairs or (a in opened and b in opened) for b in range(a + 1, hi))
            assert all((a, b) in pairs for b in range(a + 1, min(a + 1 + neardup.CROWD, hi)) if a // cut == b // cut)
    assert all(of[a] == of[b] and b - a <= neardup.WINDOW for a, b in pairs)
    assert len(pairs) == sum(r["a"] != r["b"] for r in got) and len(opened) == len(got) - len(pairs)
    if tasks == 1:
        # as many open nodes as have a node of their run WINDOW places away
        far = {n for n in range(len(of)) for m in (n - neardup.WINDOW, n + neardup.WINDOW) if 0 <= m < len(of) and of[m] == of[n]}
        assert far <= opened and len(opened - far) <= neardup.WINDOW * 2
        assert len(got) < (neardup.CROWD + 4) * len(of)


def test_rows_that_stay_are_not_shuffled(spark):
    texts = [prose(300 + i, 40) for i in range(40)] + [prose(300, 40)]
    ids = [*range(40), 77]
    docs = documents(spark, texts, ids).repartition(3)
    left = neardup.without_near_duplicates(docs)
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(40))
    doubtful = neardup._perhaps(spark.createDataFrame([(77,), (None,)], "doc_id long"))
    found = docs.filter(doubtful(docs["doc_id"])).collect()
    assert [r["doc_id"] for r in found] == [77]
    # a part of the union reads the table and moves nothing
    parts = left._jdf.queryExecution().optimizedPlan()
    assert parts.nodeName() == "Union" and "Join" not in parts.children().head().toString()
    awkward = documents(spark, ["a b", "c d"], [None, 77])
    assert awkward.filter(doubtful(awkward["doc_id"])).count() == 2


def test_short_signatures_agree_as_their_low_bits_do():
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 1 << 16, (50, neardup.HASHES)).astype(">u2")
    y = np.where(rnd.random(x.shape) < 0.7, x, rnd.integers(0, 1 << 16, x.shape)).astype(">u2")
    low = (1 << neardup.SHORT_BITS) - 1
    assert neardup._short(x).nbytes == len(x) * neardup.HASHES * neardup.SHORT_BITS // 8
    assert np.allclose(neardup._agreement(neardup._short(x), neardup._short(y)), ((x & low) == (y & low)).mean(axis=1))
