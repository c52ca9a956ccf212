"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from flowlake.llm import phrases
from tests.llm.helpers import awkward_texts, documents, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, langs, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for t, lang in zip(texts, langs):
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        rows = []
        frequent = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        longer = Counter()
        for p, a in frequent.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], a)
        for p, a in frequent.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, c = min((2_000_000 * a // (counts[p[:c]] + counts[p[c:]]), c) for c in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:c]], counts[p[c:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(docs, **options):
    got = phrases.collocations(docs, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def corpus(seed=0, n=120):
    rnd = random.Random(seed)
    fixed = ["New York City Hall", "of the", "in spite of", "a b", "ÉTÉ à la plage", "one; two, three", "state-of-the-art work"]
    vocabulary = prose(5, 300, 25).split()
    return [" ".join(rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(vocabulary) + rnd.choice(["", "", ".", ",", "\n"])
                     for _ in range(rnd.randint(0, 80))) for _ in range(n)]


def test_equal_to_brute_force_with_awkward_rows(spark):
    texts = corpus() + [t if t is None or len(t) < 50_000 else t[:50_000] for t in awkward_texts()] + ["same words " * 40] * 3
    langs = [["en", "de", None][k % 3] for k in range(len(texts))]
    docs = documents(spark, texts, [None, 1, 1] + list(range(len(texts) - 3)), ["x"] * len(texts)).drop("lang")
    # languages with nulls: the helper's own list cannot hold them
    rows = [(t, g, k) for k, (t, g) in enumerate(zip(texts, langs))]
    own = spark.createDataFrame(rows, "text string, lang string, w1 long")
    want = brute(texts, langs)
    assert len(want) > 20 and {r[0] for r in want} == {"en", "de", "und"}
    assert run(own.repartition(3)) == want
    assert run(own, top=5) == [r for r in want if r[1] <= 5]
    assert run(docs.selectExpr("text", "'en' AS lang", "node", "root AS segment")) == brute(texts, ["en"] * len(texts))


@pytest.mark.parametrize("change", [{"SPLIT": 40}, {"CHUNK": 300}, {"FILTER_BITS": 1 << 10}, {"SALTS": 1}])
def test_segments_chunks_and_a_full_filter_change_nothing(spark, monkeypatch, change):
    texts = corpus(1, 150)
    langs = ["en"] * 100 + ["fr"] * 50
    docs = spark.createDataFrame(list(zip(texts, langs)), "text string, lang string").repartition(4)
    for key, value in change.items():
        monkeypatch.setattr(phrases, key, value)
    if "SPLIT" in change:
        monkeypatch.setattr(phrases, "HOT_PREFIXES", 1 << 40)
    assert run(docs) == brute(texts, langs)


def test_equal_hashes_start_anew(spark, monkeypatch):
    """The first seed's hashes are only six bits, so different words meet."""
    texts = corpus(2, 60)
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    seen = []

    def count(source, seed, real=phrases.count_words):
        seen.append(seed)
        out = real(source, seed)
        return out if seed else out.withColumn("w1", out["w1"].bitwiseAND(63))

    monkeypatch.setattr(phrases, "count_words", count)
    assert run(docs) == brute(texts, ["en"] * len(texts)) and seen == [0, 1]


def test_stripes_give_extensions_totals_and_wait_across_batches():
    schema = pa.schema([("lang", pa.string()), ("w1", pa.int64()), ("segment", pa.int32()), ("next", pa.list_(pa.int64())), ("count", pa.list_(pa.int64()))])
    rows = [("en", 1, 0, [0, 7, 9], [4, 2, 1]), ("en", 1, 0, [7], [3]), ("en", 2, 0, [7], [5]), ("fr", 2, 0, [7, 8], [1, 1]), ("fr", 2, 0, [8], [9])]
    want = [("en", 1, 0, [7], [5], 10), ("en", 2, 0, [7], [5], 5), ("fr", 2, 0, [8], [10], 11)]
    for cut in range(len(rows) + 1):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in part], schema) for part in (rows[:cut], rows[cut:])]
        got = [tuple(r.values()) for b in phrases.merge_sorted(iter(batches), ["lang", "w1", "segment"], 5) for r in b.to_pylist()]
        assert got == want


def test_tables_without_phrases(spark):
    docs = documents(spark, ["a few words", None, ""])
    assert run(docs) == [] and run(docs.limit(0)) == []


def test_filter_holds_all_its_keys():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 500).astype(np.uint64)
    words = np.zeros(1 << 7, np.uint64)
    for at in phrases.Filter.places(keys, 1 << 13):
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(int), np.left_shift(np.uint64(1), at & np.uint64(63)))
    assert phrases.Filter(1 << 13, words).holds(keys).all()
