"""BPE (9) and directly addressable codes (5) against the public library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowlake.llm import bpe, codes
from flowlake.llm.common import text_buffer, work_path
from tests.llm.helpers import awkward_texts, documents, prose

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def noise(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice("abcdetheinzqAB 1'sé\n-́\xa0\x1f") for _ in range(rnd.randint(1, 60))) for _ in range(n)]


def test_encoding_equals_the_library():
    library, own = Tokenizer.from_file(BYTES), bpe.Encoder(BYTES)
    texts = [t or "" for t in awkward_texts()] + noise(400)
    for ids, ref in zip(own.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == ref.ids
        assert own.vocab.decode(ids).decode("utf-8", "replace") == library.decode(ref.ids, skip_special_tokens=False)


def test_speculation_is_verified_by_the_exact_merges():
    vocab = bpe.Vocabulary(BYTES)
    pieces = list({p.encode() for t in noise(300) for p in t.split()})
    assert vocab.encode_pieces(pieces) == [vocab.exact(p) for p in pieces]
    assert any(vocab.greedy(p) != vocab.exact(p) for p in pieces)


def test_documents_in_spark(spark):
    library = Tokenizer.from_file(BYTES)
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in bpe.encode_documents(docs, BYTES, keep_ids=True).collect()}
    for i, t in enumerate(awkward_texts()):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert rows[i]["ids"] == ids and rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(rows[i]["decoded"].encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), BYTES).count() == 0


def test_word_memory_equals_the_library():
    library, own = Tokenizer.from_file(WORDS), codes.WordEncoder(WORDS)
    texts = [t or "" for t in awkward_texts()] + noise(400)
    # white space inside words, marks at their borders, letters that change length in lower case
    texts += ["\u0391\u03a3 e\u0301\u0301 \u0301a \u00a8 \u3000z", "\u0130x \u1e9e \x1cq \x85r 1\uff12 a\u200bb", "\u0308\u0301 \ufeff ok"] * 2
    import pyarrow as pa
    got = own.encode(*text_buffer(pa.array(texts)))
    assert [x.tolist() for x in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("top", [200, 300, 70_000, 2 ** 32 - 1])
def test_codes_round_trip_and_random_access(top):
    rnd = np.random.default_rng(top)
    ids = np.concatenate([rnd.integers(0, top, 3000), rnd.integers(0, min(top, 256), 2000), [0, top]])
    own = codes.Codes(codes.pack(ids))
    assert (own.all() == ids).all()
    at = rnd.integers(0, len(ids), 500)
    assert (own.at(at) == ids[at]).all()


def test_files_hold_every_token_in_order(spark):
    ids = [5, 3, None, 9, 3, 1]
    texts = ["the cat sat", "on the mat", "no id", None, "again three", "long " * 9000]
    docs = documents(spark, texts, ids).repartition(3)
    path = work_path(spark, "test-codes")
    codes.write_codes(docs, WORDS, 2, path)
    library, before = Tokenizer.from_file(WORDS), 0
    rows = sorted(codes.read_documents(spark, path, keep_ids=True).collect(), key=lambda r: r["start"])
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert [r["doc_id"] for r in rows] == [i for i, _ in order]
    for r, (_, t) in zip(rows, order):
        want = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert r["ids"] == want and r["start"] == before and r["n_tokens"] == len(want)
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        before += len(want)
    flat = [x for r in rows for x in r["ids"]]
    asked = spark.createDataFrame([(0,), (5,), (before - 1,), (before,)], "position long")
    got = {r["position"]: r["id"] for r in codes.tokens_at(asked, path).collect()}
    assert got == {0: flat[0], 5: flat[5], before - 1: flat[-1], before: None}


def test_an_empty_table_gives_an_empty_file(spark):
    path = work_path(spark, "test-codes-empty")
    codes.write_codes(documents(spark).limit(0), WORDS, 2, path)
    assert codes.read_documents(spark, path).count() == 0


def test_encoders_of_a_worker_share_the_vocabulary():
    first, second = bpe.Encoder(BYTES), bpe.Encoder(BYTES)
    assert first.vocab is second.vocab and first.place is not second.place


def test_texts_are_cut_into_small_batches_without_loss(spark):
    texts = [prose(k, 40_000) for k in range(6)] + ["", None, "x" * 3]
    assert sum(len(t or "") for t in texts) > 2 * bpe.BATCH_BYTES
    rows = {r["doc_id"]: r for r in bpe.encode_documents(documents(spark, texts).coalesce(1), BYTES).collect()}
    encoder = bpe.Encoder(BYTES)
    assert {k: r["n_tokens"] for k, r in rows.items()} == {k: len(encoder.encode_batch([t or ""])[0]) for k, t in enumerate(texts)}
