"""Shards: whole, near equal, gapless, groups together, hot groups cut."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlake.llm import common, shards
from tests.llm.helpers import CLASHING, awkward_texts, documents, prose


def run(docs, n, tmp_dir):
    plan = shards.write_shards(docs, n, f"{tmp_dir}/s")
    return shards.read_shards(docs.sparkSession, f"{tmp_dir}/s", docs.schema).collect(), plan


def check(rows, docs, n):
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def sizes(rows, n):
    out = np.zeros(n)
    for r in rows:
        out[r["shard"]] += len((r["text"] or "").encode()) + 1
    return out


def test_range_search_equals_brute_force():
    rnd = np.random.default_rng(1)
    keys = sorted({(int(a), int(b)) for a, b in rnd.integers(-4, 5, (40, 2))} | {(2, shards.FIRST_ID)})
    h, i = rnd.integers(-6, 7, 500), rnd.integers(-6, 7, 500)
    want = [sum(k <= (a, b) for k in keys) for a, b in zip(h.tolist(), i.tolist())]
    assert shards.Splitters(keys).range_of(h, i).tolist() == want
    assert shards.Splitters([]).range_of(h, i).tolist() == [0] * 500


def test_cuts_keep_groups_but_split_heavy_ones():
    even = [(k, k, 1.0) for k in range(100)]
    assert [h for h, _ in shards.quantile_cuts(even, 4)] == [24, 49, 74]
    heavy = [(1, k, 1.0) for k in range(10)] + [(5, k, 1.0) for k in range(80)] + [(9, k, 1.0) for k in range(10)]
    cuts = shards.quantile_cuts(heavy, 4)
    assert (5, shards.FIRST_ID) in cuts and (9, shards.FIRST_ID) in cuts and sum(h == 5 for h, _ in cuts) >= 4
    assert shards.quantile_cuts([], 4) == [] and shards.quantile_cuts(even, 1) == []


def test_near_equal_bytes_and_small_groups_together(spark, tmp_dir):
    texts = [prose(k, 5 + 7 * (k % 40)) for k in range(1500)]
    texts += [texts[k] for k in range(0, 1500, 5)] + [None, "", None]
    docs = documents(spark, texts, extra=False)
    rows, plan = run(docs, 8, tmp_dir)
    check(rows, docs, 8)
    size = sizes(rows, 8)
    largest = max(len(t or "") + 1 for t in texts)
    assert abs(size - size.mean()).max() <= 2 * shards.TOLERANCE * size.mean() + largest
    where = defaultdict(set)
    for r in rows:
        where[zlib.crc32((r["text"] or "").encode())].add(r["shard"])
    assert sum(len(x) > 1 for x in where.values()) <= 7
    assert plan.size.sum() == size.sum() and plan.rows.sum() == len(texts)


def test_a_group_of_a_third_of_all_rows_is_cut(spark, tmp_dir):
    texts = [prose(k, 30) for k in range(800)] + ["the same text over and over again, many times"] * 1600
    docs = documents(spark, texts, extra=False)
    rows, _ = run(docs, 8, tmp_dir)
    check(rows, docs, 8)
    size = sizes(rows, 8)
    assert len({r["shard"] for r in rows if r["text"] == texts[-1]}) > 1
    assert abs(size - size.mean()).max() <= 2 * shards.TOLERANCE * size.mean() + 400


def test_one_very_long_text(spark, tmp_dir):
    docs = documents(spark, ["z" * 300_000] + [prose(k, 20) for k in range(300)], extra=False)
    rows, _ = run(docs, 4, tmp_dir)
    check(rows, docs, 4)
    assert sorted(sizes(rows, 4))[-1] < 300_000 + 30_000


@pytest.mark.parametrize("n", [1, 3, 40])
def test_awkward_rows(spark, tmp_dir, n):
    texts = awkward_texts()
    ids = [None, None, None, 7, 7] + list(range(5, len(texts)))
    docs = documents(spark, texts, ids)
    rows, _ = run(docs, n, tmp_dir)
    check(rows, docs, n)
    assert set(CLASHING) <= set(rows[0].asDict())


def test_empty_table_and_own_shard_column(spark, tmp_dir):
    docs = documents(spark, ["a", "b", "b"], [1, 2, 2])
    rows, _ = run(docs.limit(0), 8, f"{tmp_dir}/0")
    assert rows == []
    rows, _ = run(docs.withColumnRenamed("node", "shard").withColumnRenamed("root", "slot"), 2, f"{tmp_dir}/1")
    assert len(rows) == 3 and {r["slot"] for r in rows} <= {0, 1, 2}


def test_rows_are_sorted_once_and_keys_make_no_files(spark, tmp_dir, monkeypatch):
    """A second sort in the writer holds a task's rows twice; on a local store each file starts a copy of the JVM."""
    docs = documents(spark, [prose(k, 5 + k % 40) for k in range(300)] + [None, ""], extra=False)
    made = []
    for module in (common, shards):
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", lambda df, name, real=module.written: made.append(name) or real(df, name))
    rows, plan = run(docs, 8, tmp_dir)
    check(rows, docs, 8)
    assert not made
    order = shards.placed(docs, plan, "doc_id", "text")._jdf.queryExecution().optimizedPlan().outputOrdering()
    assert order.head().child().toString().startswith("shard#")
