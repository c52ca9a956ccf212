"""The pipeline against a brute-force composition, and its stages on awkward rows."""

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from flowlake.llm import pii
from flowlake.llm.common import table
from tests.llm.helpers import awkward_texts, documents, prose
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_run_equals_a_brute_force_composition(spark):
    rows = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect() if any(map(str.isalpha, r["text"] or ""))}
    groups = brute(list(rows.values()), list(rows), 5, 80)
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in rows.items():
        if groups[i][2] and not any(x in t for x in items):
            masked = pii.mask(t, pii.base_spans(t))
            ids = library.encode(masked, add_special_tokens=False).ids
            want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(masked.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_columns_and_survive_awkward_rows(spark):
    texts = awkward_texts() + [prose(40, 60)] * 3 + [f"{prose(41, 60)} me@mail.example.com"]
    first = table(spark, SF, "documents").limit(40).select("doc_id", "text", "lang", "source", "n_chars")
    docs = documents(spark, texts, [1000 + i for i in range(len(texts) - 2)] + [1000, None], extra=False).unionByName(first)
    docs = docs.selectExpr("*", "doc_id as node", "doc_id as root", "text as words", "n_chars as key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        assert 0 < out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    masked = corpus_pipeline.personal_data(spark, docs, SF).filter("doc_id is null").first()
    assert masked["text"].endswith("[EMAIL]") and masked["n_chars"] == len(masked["text"])


def test_every_operator_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
