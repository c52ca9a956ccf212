"""Block-max search against all examples; held-out accuracy; awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from flowlake.llm import toxicity
from flowlake.llm.common import in_fold, table
from tests.llm.helpers import awkward_texts, documents

SF = "/root/testdata/sf0.01"


def index(n=400, terms=12, seed=1):
    rnd = np.random.default_rng(seed)
    t = toxicity.Terms(np.sort(rnd.integers(1, 2 ** 63, terms, dtype=np.uint64)), rnd.uniform(0.2, 3, terms + 1))
    rows = []
    for i in range(n):
        places = sorted(rnd.choice(terms + 1, int(rnd.integers(0, 5)), replace=False).tolist())
        rows.append((i, int(rnd.integers(0, 2)), places, [int(x) for x in rnd.integers(1, 4, len(places))]))
    return toxicity.Index(t, rows), rows


def test_block_max_search_equals_all_cosines():
    own, rows = index()
    for _, _, places, levels in rows[:150]:
        if not places:
            continue
        best, cosines = own.nearest(places, levels)
        dense = np.zeros((own.n, len(own.terms.hash) + 1))
        for t, (e, w) in enumerate(zip(own.example, own.weight)):
            dense[e, t] = w
        at, w = own.weights(places, levels)
        q = np.zeros(dense.shape[1])
        q[at] = w
        every = dense @ q
        order = np.lexsort((np.arange(own.n), -np.round(every, 12)))[:toxicity.K]
        order = order[every[order] > 0]
        assert np.allclose(np.sort(every[order])[::-1], cosines)
        assert best.tolist() == order.tolist()


def test_chance_rises_with_the_vote():
    own, _ = index(600)
    assert (np.diff(own.chance) > 0).all() and (np.diff(own.levels) > 0).all()


def test_held_out_accuracy(spark):
    docs, labels, held = table(spark, SF, "documents"), table(spark, SF, "labels"), in_fold("doc_id", 5, 0)
    fitted = toxicity.fit(docs, labels, ~held)
    rows = (toxicity.score_toxicity(docs, fitted).join(labels, "doc_id").filter(held)
            .agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("toxic")).cast("double")).alias("share"),
                 F.avg(F.when(F.col("toxic") == 1, F.col("score"))).alias("one"), F.avg(F.when(F.col("toxic") == 0, F.col("score"))).alias("zero")).first())
    assert rows["share"] >= 0.9 and rows["one"] > rows["zero"] + 0.3


def test_awkward_rows(spark):
    texts = awkward_texts() + ["you filthy idiot", "an idiot again", "what a fine day", "such a fine idea", "idiot idiot"] * 3
    docs = documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, 1, int("idiot" in t), 7) for i, t in enumerate(texts) if t] + [(0, 1, None, 7), (None, 1, 1, 7), (3, 1, 0, 7), (3, 0, 0, 7)],
        "doc_id long, quality int, toxic int, text long")
    fitted = toxicity.fit(docs, labels, F.lit(True))
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, fitted).collect()}
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows.values())
    n = len(awkward_texts())
    assert rows[n]["score"] > 0.5 > rows[n + 2]["score"] and rows[n]["evidence"]
    assert toxicity.score_toxicity(docs.limit(0), fitted).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in toxicity.score_toxicity(docs, nothing).collect()} == {0.0}
