"""The language model: counts and base against a direct count, and probabilities that sum to one."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import lm, wordbits
from flowlake.llm.common import in_fold, table
from tests.llm.helpers import awkward_texts, documents, prose


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def test_rows_counts_and_base(spark):
    texts = awkward_texts() + [prose(1, 300), prose(21, 200), prose(1, 50)]
    docs = documents(spark, texts)
    held = F.col("doc_id") % 4 == 1
    rows = {r["doc_id"]: r for r in lm.score_texts(docs, held).collect()}
    assert len(rows) == len(texts)
    count = Counter()
    for i, t in enumerate(texts):
        if i % 4 != 1:
            count.update([*tokens(t), None])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        own = [*tokens(t), None]
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i % 4 == 1, len(own), n)
        assert r["n_known"] == sum(count[x] > 0 for x in own)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (n + v + 1)) for x in own), abs_tol=1e-6)
        assert r["score"] < 0


def test_the_model_beats_the_base_on_held_out_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = lm.score_texts(docs, in_fold("doc_id", 7, 2)).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert rows[2] > 100 and rows[0] > rows[1]


def test_nothing_to_learn_and_empty_tables(spark):
    docs = documents(spark, ["some words here", None])
    rows = {r["doc_id"]: r for r in lm.score_texts(docs, F.lit(True)).collect()}
    assert rows[0]["base_score"] == 0 and rows[0]["n_known"] == 0 and rows[0]["train_tokens"] == 0 and rows[0]["score"] < 0
    assert lm.score_texts(docs.limit(0), F.lit(False)).count() == 0


def test_spelling_bits_sum_to_one():
    tables, mixer = lm.Tables(), lm.Mixer()
    words = [w.encode() for w in set(prose(3, 500).split())]
    tables.add(words)
    mixer.learn(tables, words)
    # the chance of a first byte is the product of its eight bits: all 256 sum to one
    share = (mixer.map_ones + 0.5) / (mixer.map_all + 1)
    trust = mixer.map_all / (mixer.map_all + 64) * 0.5
    total = 0.0
    for byte in range(256):
        _, bit, slots, (place, node) = lm.spelling([bytes([byte])])
        x, seen = tables.inputs(slots[:8], None)
        z = np.einsum("ij,ij->i", x, mixer.weights[mixer.gate(place[:8], seen)])
        at = mixer._bin(z)
        t = trust[node[:8], at]
        p = (1 - t) * lm._squash(z) + t * share[node[:8], at]
        total += np.prod(np.where(bit[:8] == 1, p, 1 - p))
    assert total == pytest.approx(1, abs=1e-6)
    seen_word, odd = mixer.log10(tables, [words[0], bytes(reversed(words[0])) + b"qqq"])
    assert seen_word > odd


def test_text_steps_sum_to_one_over_the_vocabulary():
    experts = lm.Experts(np.array([30, 10]), np.array([3, 2]), 3, 4)
    counts = np.array([[20, 1], [9, 0], [1, 9], [0, 0]])
    known = experts.known(counts)
    spelling = np.log10([0.2, 0.3, 0.1, 0.4])               # all words there are
    for history in ([], [0], [0, 2, 2, 3], [3, 3, 1, 0, 0]):
        before = experts.log10(np.array(history, int), known, spelling) - math.log10(experts.end)
        steps = [10 ** (experts.log10(np.array([*history, w]), known, spelling) - math.log10(experts.end) - before) for w in range(4)]
        # the words share what the end leaves; Q_k itself keeps D_k of a class for words unseen in it
        assert sum(steps) <= 1 - experts.end + 1e-9
        assert sum(steps) > (1 - experts.end) * 0.9


def test_words_of_any_length_and_bytes():
    for words in ([b"a"], [b"x" * 5000, b"y"], [bytes([255, 254])], [b"a", b"b"] * 3):
        word, bit, slots, _ = lm.spelling(words)
        assert len(bit) == 8 * sum(len(w) + 1 for w in words) and len(slots) == len(bit)
        assert sorted(set(word.tolist())) == list(range(len(words)))


def test_long_words_pay_for_their_whole_spelling():
    experts = lm.Experts(np.array([30, 10]), np.array([3, 2]), 3, 4)
    known = experts.known(np.array([[20, 1], [0, 0]]))
    for cost in (-20.0, -320.0, -4000.0):
        score = experts.log10(np.array([0, 1]), known, np.array([-3.0, cost]))
        alone = experts.log10(np.array([0]), known, np.array([-3.0]))
        step = math.log10(experts.spelled) + cost + math.log10((lm.KAPPA + lm.D_OWN) / (lm.KAPPA + 1)) + math.log10(1 - experts.end)
        assert score - alone == pytest.approx(step, abs=1e-9)


def test_scores_of_whole_long_words(spark):
    texts = [prose(1, 300), "z9" * 1500, "z9" * 3000]
    rows = {r["doc_id"]: r["score"] for r in lm.score_texts(documents(spark, texts), F.col("doc_id") > 0).collect()}
    assert rows[2] < rows[1] - 200 and rows[1] < -200


def running_model(seed=5):
    rnd = np.random.default_rng(seed)
    hashes = rnd.integers(-2 ** 63, 2 ** 63 - 1, 40)
    counts = rnd.integers(8, 400, (40, 2))
    tree = wordbits.Tree(hashes, counts, 900, 120)
    mixer = wordbits.Mixer(16)
    h = np.concatenate([hashes.view(np.uint64), rnd.integers(0, 2 ** 63, 30, dtype=np.uint64)])
    for _ in range(20):
        row = h[rnd.integers(0, len(h), 200).cumsum() % len(h)]
        token, context, _ = wordbits.sequence(tree, tree.symbols(row), wordbits.short(row), np.array([0, 90, 90, 200]))
        mixer.learn(tree, token, context)
    mixer.merge([mixer.state()])
    return tree, mixer.freeze(), h


def test_the_bits_of_all_tokens_sum_to_one_in_any_context():
    tree, mixer, h = running_model()
    assert tree.symbols(h[:40]).tolist() == list(range(2, 42)) and not tree.symbols(h[40:]).any()
    _, context, _ = wordbits.sequence(tree, tree.symbols(h), wordbits.short(h), np.array([0, 20, 70]))
    every = np.arange(42, dtype=np.int32)
    for at in (0, 1, 2, 20, 21, 55):
        own = np.repeat(context[:, at:at + 1], 42, axis=1)
        assert (10 ** mixer.log10(tree, every, own)).sum() == pytest.approx(1, abs=1e-4)


def test_contexts_are_the_words_before_within_the_row():
    tree, _, h = running_model()
    bound = np.array([0, 3, 3, 5])
    token, context, row = wordbits.sequence(tree, tree.symbols(h[:5]), wordbits.short(h[:5]), bound)
    assert row.tolist() == [0, 0, 0, 0, 1, 2, 2, 2] and (token == wordbits.END).tolist() == [False] * 3 + [True, True] + [False] * 2 + [True]
    assert context[0, 0] == context[0, 4] == context[0, 5] and context[1, 0] == context[1, 4] == context[1, 5]
    assert len(set(context[0].tolist())) == 6 and len(set(context[1].tolist())) == 6


def test_own_text_and_its_end_share_one():
    p = np.log([0.3, 0.2, 0.4])
    for history in ([], [0], [0, 2, 2, 1]):
        total = 0.0
        for w in range(3):
            ids = np.array([*history, w])
            total += math.exp(lm.own_text(ids, p[ids], np.zeros(1), np.array([0, len(ids)]))[0][-1])
        ids = np.array(history, int)
        total += math.exp(lm.own_text(ids, p[ids], np.log([0.1]), np.array([0, len(ids)]))[1][0])
        assert total == pytest.approx(1)


def test_known_words_are_scored_by_the_words_before_them(spark):
    rnd = np.random.default_rng(1)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(words[(k + j) % 20] for j in range(20)) for k in rnd.integers(0, 20, 300)]
    learnt = " ".join(words)
    texts += [learnt, " ".join(rnd.permutation(words))]     # the same words, each once
    rows = {r["doc_id"]: r for r in lm.score_texts(documents(spark, texts, lang=["en"] * 302), F.col("doc_id") >= 300).collect()}
    assert rows[300]["base_score"] == pytest.approx(rows[301]["base_score"])
    assert rows[300]["score"] > rows[301]["score"] + 5


def test_block_words_take_payloads_one_by_one():
    rnd = np.random.default_rng(5)
    n, classes = 400_000, 8
    counts = rnd.integers(0, 9, (n, classes)) * (rnd.random((n, 1)) < 0.7)
    experts = lm.Experts(counts.sum(0), (counts > 0).sum(0), int((counts.sum(1) > 0).sum()), 77)
    symbol = np.where(rnd.random(n) < 0.9, wordbits.OTHER, 5).astype(np.int32)
    lp, short = rnd.normal(-9, 2, n).astype(np.float32), rnd.integers(0, 1 << 32, n, dtype=np.uint32)
    order = rnd.permutation(n).astype(np.int32)
    payloads = [np.frombuffer(b"".join(lm.planes(x) for x in (at, lp[at], symbol[at], short[at], *(counts[at, k].astype("<i8") for k in range(classes)))), np.uint8)
                for at in np.array_split(order, 5)]
    tracemalloc.start()
    try:
        uses, known, spelling, symbols, shorts = lm.block_words(payloads, classes, experts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    other = np.where((symbol == wordbits.OTHER)[:, None], counts, 0)
    assert (uses == counts.sum(1)).all() and (known == experts.known(other)).all()
    assert (spelling == lp).all() and (symbols == symbol).all() and (shorts == short).all()
    # the answers and a share of the payloads; all counts beside the chances and their terms would be four times that
    assert peak < 2 * n * (8 * classes + 24)
    assert not payloads


def test_index_arrays_are_native():
    """numpy casts others in slow steps at each use."""
    tree, mixer, _ = running_model()
    token = np.array([wordbits.OTHER, 2, wordbits.END, 3], np.int32)
    context = np.arange(4 * wordbits.CONTEXTS, dtype=np.uint32).reshape(wordbits.CONTEXTS, 4) * np.uint32(0x9E3779B1)
    length, bit, slots, own, depth = mixer._steps(tree, token, context)
    assert length.tolist() == [tree.length[t] for t in token] and all(len(x) == length.sum() for x in (bit, own, depth, *slots))
    z, gate = mixer._mixed([own] * (1 + wordbits.CONTEXTS), [np.zeros(len(own), np.int8)] * wordbits.CONTEXTS, depth)
    _, _, spelt, (place, _) = lm.spelling([b"abc", b"d"])
    assert {x.dtype for x in (*slots, gate, mixer._bin(z), lm.Mixer.gate(place, np.zeros(len(spelt), np.int32)))} == {np.dtype(np.intp)}


def test_own_text_takes_unused_words_as_they_are():
    rnd = np.random.default_rng(4)
    bound = np.array([0, 0, 40, 41, 300])
    ids, p, ends = rnd.integers(0, 30, 300), np.log(rnd.random(300)), np.log(rnd.random(4))
    got, got_ends = lm.own_text(ids, p, ends, bound)
    for i, (lo, hi) in enumerate(zip(bound[:-1].tolist(), bound[1:].tolist())):
        seen = Counter()
        for t, k in enumerate(ids[lo:hi].tolist()):
            chance = (max(seen[k] - lm.D_OWN, 0) + (lm.KAPPA + lm.D_OWN * len(seen)) * math.exp(p[lo + t])) / (t + lm.KAPPA)
            assert math.isclose(got[lo + t], math.log(chance), rel_tol=1e-12, abs_tol=1e-12)
            seen[k] += 1
        assert math.isclose(got_ends[i], ends[i] + math.log((lm.KAPPA + lm.D_OWN * len(seen)) / (hi - lo + lm.KAPPA)), rel_tol=1e-12, abs_tol=1e-12)
