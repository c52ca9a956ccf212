"""Leaks, re-parameterised leaks and clean texts."""

from pyspark.sql import functions as F

from flowlake.llm import decontam
from tests.llm.helpers import awkward_texts, documents, prose

ITEM = ("A farmer sells 12 crates of ripe apples to a shop in Boston, and each crate weighs 30 kg before noon, so how many "
        "kg does the shop of mister Miller receive when 12 crates arrive each day?")
CHANGED = (ITEM.replace("12", "47").replace("30 kg", "9 lb").replace("many kg", "many lb").replace("Boston", "Madrid").replace("Miller", "Ortega"))
INCONSISTENT = ITEM.replace("12 crates of", "47 crates of").replace("30 kg", "8 lb").replace("when 12", "when 99").replace("Boston", "Oslo")


def leaks(spark, texts, items, ids=None):
    docs = documents(spark, texts, ids)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, size long")
    return {(r["doc_id"], r["item_id"]): r for r in decontam.find_leaks(docs, bench).collect()}


def test_template_and_slots(spark):
    t = F.col("t")
    row = spark.createDataFrame([("He paid 5 KG and John Smith took 7.5 miles, ok \ue001",)], "t string").select(
        decontam.template(t).alias("w"), F.transform(decontam.tokens(t), decontam.slot_value).alias("v")).first()
    assert row["w"] == ["he", "paid", "0", "2", "and", "1", "took", "0", "miles", "ok"]
    assert row["v"] == [None, None, "0:5", "2:kg", None, "1:John Smith", None, "0:7.5", None, None]


def test_long_runs_of_slots_do_not_recurse(spark):
    n = 100_000
    texts = ["1." * n, "1 " * n, "a " + "Abc " * n, "a " + "Abc, " * n, "5 kg " * n, "x " * n]
    t = F.col("text")
    rows = documents(spark, texts).select("doc_id", F.size(decontam.template(t)).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in rows} == {0: 1, 1: n, 2: 2, 3: n + 1, 4: 2 * n, 5: n}
    assert {(5, 0)}.isdisjoint(leaks(spark, texts, [ITEM]))


def test_every_offset_is_probed(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    part = " ".join(item.split()[:9]) + " and then nothing of it"
    got = leaks(spark, [" ".join(["pad"] * k + [part]) for k in range(12)], [item])
    assert set(got) == {(k, 0) for k in range(12)} and {r["n_matched"] for r in got.values()} == {2}


def test_two_variants_and_repeated_phrases(spark):
    box = "box one has 5 red balls and 3 blue balls so box two has 4 red balls and 9 blue balls while box six has 8 red balls and 2 blue balls"
    texts = [f"{ITEM} {prose(1, 30)} {CHANGED}", f"{CHANGED} then {CHANGED.replace('47', '48').replace('9 lb', '7 oz').replace('many lb', 'many oz')}", box,
             " ".join(map(str, range(40)))]
    items = [ITEM, box, " ".join(map(str, range(1, 21)))]
    got = leaks(spark, texts, items)
    assert {(0, 0), (1, 0), (2, 1), (3, 2)} <= set(got)
    assert got[(0, 0)]["coverage"] == 1.0 and got[(2, 1)]["coverage"] == 1.0 and got[(3, 2)]["coverage"] == 1.0


def test_number_tables_end(spark):
    table = " ".join(str(k * 7 % 1000) for k in range(3000))
    got = leaks(spark, [table, prose(2, 50)], [" ".join(str(k) for k in range(100, 140))])
    assert {d for d, _ in got} <= {0}


def test_inserted_words_stay_one_copy(spark):
    words = ITEM.split()
    text = " ".join(words[:11] + ["really", "quite"] + words[11:24] + ["indeed"] + words[24:])
    assert leaks(spark, [text], [ITEM])[(0, 0)]["coverage"] > 0.4


def test_planted_reparameterised_and_clean_texts(spark):
    noise = [prose(50 + i, 200) for i in range(4)]
    texts = [noise[0], f"{noise[0]} {ITEM} {noise[1]}", CHANGED, ITEM.upper(), f"{noise[2]} {ITEM[60:]}", noise[3], INCONSISTENT]
    got = leaks(spark, texts, [ITEM, prose(99, 40)])
    assert {(1, 0), (2, 0), (3, 0), (4, 0)} <= set(got) and {d for d, _ in got}.isdisjoint({0, 5})
    assert got[(2, 0)]["consistency"] == 1.0 and got[(1, 0)]["coverage"] > 0.9
    assert (6, 0) not in got or got[(6, 0)]["consistency"] < 1.0


def test_short_items_are_found_whole(spark):
    short = "seven odd words make this little item"
    texts = [f"{prose(7, 30)} {short} {prose(8, 30)}", prose(9, 60), "seven odd words make"]
    assert set(leaks(spark, texts, [short, "", None, "  "])) == {(0, 0)}


def test_awkward_rows(spark):
    texts = awkward_texts() + [ITEM, ITEM]
    ids = [*range(len(texts) - 2), 900, 900]
    assert set(leaks(spark, texts, [ITEM, ITEM], ids)) == {(900, 0), (900, 1)}
    docs = documents(spark, texts, ids)
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    left = decontam.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == len(texts) - 2
    nameless = documents(spark, [ITEM, "clean words only", ITEM], [None, None, 3])
    assert [r["text"] for r in decontam.without_leaks(nameless, bench).collect()] == ["clean words only"]


def test_leaking_rows_without_an_id_go_and_clean_ones_stay(spark):
    clean = prose(1, 30)
    docs = documents(spark, [ITEM, clean, None, CHANGED, clean, ITEM], [None, None, None, None, 4, 5])
    bench = spark.createDataFrame([(0, ITEM, 1)], "item_id long, text string, size long")
    kept = decontam.without_leaks(docs, bench).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(None, clean), (None, None), (4, clean)], key=repr)


def test_no_python_in_the_plan(spark):
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    plan = decontam.find_leaks(documents(spark, [ITEM, "x"]), bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))


def test_texts_are_not_shuffled_to_drop_leaks(spark):
    docs = documents(spark, [ITEM, "clean words only", prose(4, 30)], [1, 2, 3])
    bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    left = decontam.without_leaks(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_few_leaks_are_not_spread_over_a_file_per_task(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = documents(spark, [f"{prose(k, 20)} {ITEM}" for k in range(30)] + [prose(2, 90)])
        bench = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
        out = decontam.find_leaks(docs, bench)
        assert out.rdd.getNumPartitions() <= 2
        assert sorted(r["doc_id"] for r in out.collect()) == list(range(30))
        assert decontam.find_leaks(docs.limit(0), bench).collect() == []
        assert [r["doc_id"] for r in decontam.without_leaks(docs, bench).collect()] == [30]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
