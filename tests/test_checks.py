"""Data tests return failing rows; empty means pass."""

from flowlake import checks


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, "b", "z")], "k long, s string, v string")
    parent = spark.createDataFrame([(1,)], "k long")
    assert checks.not_null(df, "v").count() == 1
    assert [tuple(r) for r in checks.unique_combination(df, ["k", "s"]).collect()] == [(1, "a", 2)]
    assert checks.unique(df, "k").count() == 1
    assert [r["v"] for r in checks.accepted_values(df, "v", ["x"]).collect()] == ["z"]
    assert [r["k"] for r in checks.relationships(df, "k", parent, "k").collect()] == [2]
    assert checks.custom(df, df.k > 1).count() == 1
    summary = {r["test"]: r["n_failed"] for r in checks.summary(
        {"nn": checks.not_null(df, "v"), "ok": checks.custom(df, df.k > 5)}).collect()}
    assert summary == {"nn": 1, "ok": 0}
