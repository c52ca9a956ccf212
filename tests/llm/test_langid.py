"""Viterbi against enumeration; accuracy on held-out rows; awkward rows."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from flowlake.llm import langid
from flowlake.llm.common import in_fold, table
from tests.llm.helpers import awkward_texts, documents

SF = "/root/testdata/sf0.001"


def test_viterbi_equals_enumeration():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        n, k, cost = int(rnd.integers(1, 7)), int(rnd.integers(1, 4)), float(rnd.choice([0.5, 2.0, 9.0]))
        score = rnd.normal(0, 3, (n, k)).astype(np.float32)

        def value(path):
            return sum(score[i, y] for i, y in enumerate(path)) - cost * sum(a != b for a, b in zip(path, path[1:]))

        best = max(value(p) for p in product(range(k), repeat=n))
        assert abs(value(langid.viterbi(score, cost)) - best) < 1e-4


def test_held_out_accuracy(spark):
    docs, held = table(spark, SF, "documents"), in_fold("doc_id", 4, 2)
    rows = langid.predict(docs, langid.fit(docs, ~held)).join(docs.select("doc_id", "lang"), "doc_id").filter(held)
    got = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("share"), F.count("*").alias("n")).first()
    assert got["n"] > 30 and got["share"] >= 0.95


def test_spans_of_a_mixed_text(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs, F.lit(True))
    de = docs.filter("lang = 'de' and n_chars > 400").orderBy("doc_id").first()["text"][:300]
    fr = docs.filter("lang = 'fr' and n_chars > 400").orderBy("doc_id").first()["text"][:300]
    row = langid.predict(documents(spark, [f"{de} {fr}"], lang=[None]), model, spans=True).first()
    assert [s.split(":")[0] for s in row["spans"].split(",")] == ["de", "fr"]


def test_scripts_narrow_the_candidates(spark):
    docs = documents(spark, ["привет мир это текст", "hello world this is text", "мир и текст", "the text"], lang=["ru", "en", None, None])
    model = langid.fit(docs, F.lit(True))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert got == {0: "ru", 1: "en", 2: "ru", 3: "en"}


def test_awkward_rows(spark):
    docs = documents(spark)
    model = langid.fit(table(spark, SF, "documents"), F.lit(True))
    rows = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i, t in enumerate(awkward_texts()):
        letters = bool(t) and any(map(str.isalpha, t))
        assert (rows[i]["lang_pred"] != "und") == letters and 0 <= rows[i]["score"] <= 1
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {0, 1, 2, 7}.isdisjoint(r["doc_id"] for r in kept.select("doc_id").collect())
    assert langid.predict(docs.limit(0), model).count() == 0
    nothing = langid.fit(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_word_forms_keep_to_their_word():
    d = langid.DistinctWords(["ab", "&&&", "é", "c3po"])
    w, _ = d.features()
    assert d.letters.tolist()[:4] == [2, 0, 1, 3]
    assert set(w.tolist()) == {0, 2, 3}          # "&&&" has no letters, so no n-grams


def test_a_rare_script_among_many_rows_is_learnt(spark):
    many = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("hello world this is text").alias("text"), F.lit("en").alias("lang"))
    late = many.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) > 900_000).orderBy("doc_id").limit(2).collect()
    rare = [(late[0]["doc_id"], "გამარჯობა მსოფლიო ეს არის ტექსტი", "ka"), (late[1]["doc_id"], "გამარჯობა მსოფლიო", "ka"), (None, "բարեւ աշխարհ", "hy")]
    docs = many.union(spark.createDataFrame(rare, "doc_id long, text string, lang string"))
    model = langid.fit(docs, F.lit(True))
    assert model.languages == ["en", "hy", "ka"]
    assert {r["text"] for r in langid.accepted(docs, model).filter("lang <> 'en'").collect()} == {t for _, t, _ in rare}
