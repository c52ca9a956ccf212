"""Alignment against an intersection of ranges written out plainly."""

import functools
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowlake.llm import align
from tests.llm.helpers import awkward_texts, documents, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@given(st.lists(st.integers(1, 60), max_size=40), st.lists(st.integers(-5, 70), max_size=30), st.integers(0, 45))
def test_gallop_equals_a_plain_count(ends, wanted, guess):
    ends = np.array(sorted(ends), np.int64)
    wanted = np.array(wanted, np.int64)
    got = align.gallop(ends, wanted, np.full(len(wanted), guess))
    assert got.tolist() == [int((ends < w).sum()) for w in wanted]


def plain(a_len, b_len):
    """(groups, links) of one document by comparing every pair of ranges."""
    def ranges(x):
        stop = np.cumsum(x).tolist()
        return list(zip([0, *stop[:-1]], stop))
    a, b = ranges(a_len), ranges(b_len)
    links = [(i, j) for i, (s, e) in enumerate(a) for j, (u, v) in enumerate(b) if s < v and u < e]
    cuts = sorted({e for _, e in a} & {v for _, v in b})
    groups, low = [], 0
    for c in cuts:
        groups.append((sum(low < e <= c for _, e in a), sum(low < v <= c for _, v in b)))
        low = c
    return groups, links


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.randoms(use_true_random=False)), min_size=1, max_size=5))
def test_alignment_equals_brute_force(docs):
    def split(total, rnd):
        out = []
        while total:
            out.append(rnd.randint(1, min(total, 6)))
            total -= out[-1]
        return out
    pairs = [(split(n, rnd), split(n, rnd)) for n, rnd in docs]
    a_len = np.array([x for a, _ in pairs for x in a], np.int64)
    b_len = np.array([x for _, b in pairs for x in b], np.int64)
    n_a, n_b = (np.array([len(p[s]) for p in pairs]) for s in (0, 1))
    got = align.align_ends(a_len, b_len, n_a, n_b)
    want = [plain(a, b) for a, b in pairs]
    assert got.n_groups.tolist() == [len(g) for g, _ in want]
    assert list(zip(got.a_take.tolist(), got.b_take.tolist())) == [x for g, _ in want for x in g]
    a0, b0 = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = [(i + a0[d], j + b0[d]) for d, (_, x) in enumerate(want) for i, j in x]
    assert got.n_links.tolist() == [len(x) for _, x in want]
    assert sorted(zip(got.a.tolist(), got.b.tolist())) == sorted(links)


@functools.cache
def libraries():
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    return library, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(texts):
    library, pieces = libraries()
    a_bytes, b_bytes = align.ByteLevel(A).bytes_of, align.Pieces(B).bytes_of
    rows = []
    for t in texts:
        a = library.encode(" " + t, add_special_tokens=False).ids if t else []
        b = pieces.encode(t) if t else []
        whole = (" " + t).encode() if t else b""
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a, b = [], []
        groups, links = plain([len(a_bytes[i]) for i in a], [len(b_bytes[i]) for i in b])
        rows.append((a, b, groups, [(a[i], b[j]) for i, j in links]))
    count = Counter(p for *_, links in rows for p in set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, groups, links in rows:
        text, i, j = [], 0, 0
        for x, y in groups:
            text.append(",".join(map(str, a[i:i + x])) + "|" + ",".join(map(str, b[j:j + y])))
            i, j = i + x, j + y
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""))
    return out


def result(docs):
    blocks = align.encoded(docs, A, B)
    return align.linked(blocks, align.block_pairs(blocks, A, B), A, B, digest=True), blocks


def test_awkward_texts_equal_brute_force(spark):
    texts = [t if t is None or len(t) < 2000 else t[:1500] for t in awkward_texts()]
    texts += ["<s> and </s>", "a▁b", "tab\tand  two spaces ", " lead", "café", "ﬁne", "1/2 + ½", "\U0001f600\U0001f468‍\U0001f469"]
    texts += [prose(k, 60) for k in range(20)] + [prose(3, 60)] * 10
    ids = [None, None, 5, 5] + list(range(10, len(texts) + 6))
    docs = documents(spark, texts, ids).repartition(3)
    got, blocks = result(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = Counter((i, *row) for i, row in zip(ids, brute(texts)))
    assert Counter(tuple(r) for r in got.collect()) == want
    text = {r["doc_id"]: r["groups"] for r in align.groups(blocks, A, B).collect()}
    digest = {r["doc_id"]: r["groups_sha256"] for r in got.filter("doc_id >= 10").collect()}
    assert all((hashlib.sha256(text[i].encode()).hexdigest() if text[i] else "") == d for i, d in digest.items())


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    docs = documents(spark, [prose(k, 40 + k) for k in range(40)], extra=False).coalesce(1)
    whole = sorted(map(tuple, result(docs)[0].collect()))
    monkeypatch.setattr(align, "BLOCK_BYTES", 500)
    assert sorted(map(tuple, result(docs.repartition(3))[0].collect())) == whole


ODD = ["", "a", " ", "  ", " a", "a ", "a  b", "a \u00a0b c", "\u3000 x y", "a\u2028 b", "x 's don't 'll", "\u00bfqu\u00e9 tal? \u00a1s\u00ed!", "tab \t x\n\n y", "1 2  3",
       "a\x85 b", "\u00e9 \u00e9", "<s> </s> <|endoftext|>", "e \u0301 x", "\x1c a \x1f b"]


@pytest.mark.parametrize("texts", [ODD, [prose(4, 40_000)], ["x" * 200_000, "a  b " * 40_000], ["1 2\n" * 50_000, "ab " * 70_000]])
def test_words_give_the_ids_of_whole_texts(texts):
    library, pieces = libraries()
    memory = align.memory_of(A, B)
    memory._forget()
    assert memory.by_words
    for _ in range(2):
        (a, b), (n_a, n_b) = memory.encode(texts)
        a, b = np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1])
        for t, x, y in zip(texts, a, b):
            if len(x):
                assert x.tolist() == library.encode(" " + t, add_special_tokens=False).ids and y.tolist() == pieces.encode(t)
            else:
                assert not t or b"".join(memory.sides[1].bytes_of[i] for i in pieces.encode(t)) != (" " + t).encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'1 .\n\t\u00a0\u3000\u00e9\u00bf\u2028\u4e2d"), max_size=30), max_size=4))
def test_any_text_is_cut_at_safe_places(texts):
    test_words_give_the_ids_of_whole_texts(texts)


def test_empty_table(spark):
    got, _ = result(documents(spark, ["a"]).limit(0))
    assert got.collect() == []
