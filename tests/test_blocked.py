"""Blocked scans, runs, distinct state and order proofs against their plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowlake.operators.blocked import balance_runs, blocked_forward_fill, blocked_running_sum, expand_runs, runs_at
from flowlake.operators.ordering import is_sorted, numbered, order_by, read_with_places
from flowlake.operators.series import forward_fill, running_sum
from flowlake.operators.spine import calendar_spine, densify
from flowlake.plans.distinct import add_sightings, distinct_counts, lg_k, sketched_counts, store_sketches

DAY0 = dt.date(2023, 11, 20)


def series(spark, seed=0, hot=400, none=0.4):
    rnd = random.Random(seed)
    rows = []
    for token in ["hot", "a", "b", None]:
        days = sorted(rnd.sample(range(500), hot if token == "hot" else 40))
        days += days[:3]                                      # peers of one day
        for k in days:
            rows.append((token, DAY0 + dt.timedelta(days=k), None if rnd.random() < none else rnd.randint(-50, 50)))
    return spark.createDataFrame(rows, "token string, dt date, x long")


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("block", ["month", "week", "year"])
def test_blocked_running_sum_equals_the_window(spark, block):
    df = series(spark)
    want = running_sum(df, ["token"], "dt", "x", "total")
    assert rows_of(blocked_running_sum(df, ["token"], "dt", "x", "total", block=block)) == rows_of(want)


def test_running_sum_from_stored_balances(spark):
    df = series(spark, 1)
    whole = running_sum(df, ["token"], "dt", "x", "balance")
    cut = DAY0 + dt.timedelta(days=250)
    start = (whole.filter(F.col("dt") <= cut).groupBy("token").agg(F.max_by("balance", "dt").alias("balance")))
    late = blocked_running_sum(df.filter(F.col("dt") > cut), ["token"], "dt", "x", "balance", start=start)
    assert rows_of(late) == rows_of(whole.filter(F.col("dt") > cut))


@pytest.mark.parametrize("block", ["month", "week"])
def test_blocked_fill_equals_the_window_and_keeps_leading_nulls(spark, block):
    df = series(spark, 2, none=0.8).dropDuplicates(["token", "dt"])
    want = forward_fill(df, ["token"], "dt", "x")
    got = blocked_forward_fill(df, ["token"], "dt", "x", block=block)
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    assert got.filter("x is null").count() == want.filter("x is null").count()


def test_a_hot_series_is_spread_over_blocks(spark):
    out = blocked_running_sum(series(spark), ["token"], "dt", "x", "total")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    # the rows' window is dealt by (token, block); only the block sums are scanned per token
    assert len(windows) == 2 and all("_block" in line for line in windows)


def test_runs_equal_the_dense_calendar(spark):
    as_of = DAY0 + dt.timedelta(days=120)
    tokens = spark.createDataFrame([("a", DAY0), ("b", DAY0 + dt.timedelta(days=30)), ("none", DAY0 + dt.timedelta(days=5)),
                                    ("late", as_of + dt.timedelta(days=1)), ("unknown", None)], "token string, start_date date")
    rnd = random.Random(4)
    flows = spark.createDataFrame([(t, DAY0 + dt.timedelta(days=k), float(rnd.randint(-9, 9))) for t in ("a", "b", "late", "stranger")
                                   for k in rnd.sample(range(-20, 150), 25)], "token string, dt date, amount double")
    spine = calendar_spine(tokens, as_of, ["token"])
    daily = densify(spine, flows, ["token", "dt"], "amount", "net")
    want = running_sum(daily, ["token"], "dt", "net", "balance").select("token", "dt", "net", "balance")
    runs = balance_runs(tokens, flows, ["token"], as_of)
    assert rows_of(expand_runs(runs).select("token", "dt", "net", "balance")) == rows_of(want)
    assert runs.count() <= 3 + 50 < want.count()
    points = spine.sample(0.3, 7).withColumn("tag", F.lit(1))
    looked = runs_at(runs, points, ["token"])
    assert rows_of(looked.select("token", "dt", "balance")) == rows_of(points.join(want, ["token", "dt"]).select("token", "dt", "balance"))


def transfers(spark, rows):
    return spark.createDataFrame(rows, "dt date, blockchain string, `from` string, `to` string")


def test_sightings_count_exactly_over_repeated_increments(spark, tmp_dir):
    rnd = random.Random(5)
    rows = [(dt.date(2024, rnd.randint(1, 3), rnd.randint(1, 28)), rnd.choice(["x", "y", None]), rnd.choice(["p", "q", "r", None]), f"w{rnd.randint(0, 30)}")
            for _ in range(300)]
    path = f"{tmp_dir}/seen"
    for part in (rows[:120], rows[100:], rows[100:], rows[:5], []):
        state = add_sightings(spark, transfers(spark, part), "month", path)
    got = {(r["period"], r["blockchain"]): (r["senders"], r["receivers"]) for r in distinct_counts(state).collect()}
    want = {}
    for day, chain, s, r in rows:
        a, b = want.setdefault((day.replace(day=1), chain), (set(), set()))
        a.update([s] if s else [])
        b.add(r)
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}


def test_union_of_days_equals_a_direct_sketch_and_days_are_replaced(spark, tmp_dir):
    rnd = random.Random(6)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40)), "x", f"s{rnd.randint(0, 4000)}", f"r{rnd.randint(0, 90)}") for _ in range(9000)]
    path = f"{tmp_dir}/sketches"
    first, second = rows[:5000], rows
    store_sketches(spark, transfers(spark, first), path)
    stored = store_sketches(spark, transfers(spark, second), path)         # all days again, whole
    near = {r["period"]: (r["senders"], r["receivers"]) for r in sketched_counts(stored, "month").collect()}
    direct = transfers(spark, rows).groupBy(F.trunc("dt", "month").alias("p")).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("from", lg_k(0.01))).alias("a"), F.countDistinct("from").alias("n"),
        F.countDistinct("to").alias("m")).collect()
    for r in direct:
        assert abs(near[r["p"]][0] - r["a"]) <= 0.01 * r["n"] + 1 and abs(near[r["p"]][0] - r["n"]) <= 0.03 * r["n"]
        assert abs(near[r["p"]][1] - r["m"]) <= 2
    assert lg_k(0.01) == 14 and stored.groupBy("dt", "blockchain", "role").count().filter("count > 1").isEmpty()


KEYS = [("dt", True), ("v", True)]


def test_row_numbers_and_order(spark, tmp_dir):
    rnd = random.Random(8)
    rows = [(DAY0 + dt.timedelta(days=rnd.randint(0, 20)), rnd.choice([None, rnd.random(), 0.5])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "dt date, v double").repartition(6)
    df.repartitionByRange(4, *order_by(KEYS)).sortWithinPartitions(*order_by(KEYS)).write.parquet(f"{tmp_dir}/sorted")
    placed = read_with_places(spark, f"{tmp_dir}/sorted", df.schema)
    assert placed.select("_file").distinct().count() > 1 and is_sorted(placed, KEYS)
    got = numbered(placed, KEYS).orderBy("row_no").collect()
    want = sorted(rows, key=lambda r: (-r[0].toordinal(), r[1] is None, -(r[1] or 0)))
    assert [r["row_no"] for r in got] == list(range(1, 3001)) and [(r["dt"], r["v"]) for r in got] == want
    df.write.parquet(f"{tmp_dir}/loose")
    assert not is_sorted(read_with_places(spark, f"{tmp_dir}/loose", df.schema), KEYS)


def test_a_border_out_of_order_is_found(spark, tmp_dir):
    """Each file is in order, but the second begins before the first ends."""
    for k, days in enumerate(([9, 8, 7], [8, 6, 5])):
        part = spark.createDataFrame([(DAY0 + dt.timedelta(days=d), 1.0) for d in days], "dt date, v double").coalesce(1)
        part.write.mode("append").parquet(f"{tmp_dir}/p{k}")
    rows = None
    for k in range(2):
        own = read_with_places(spark, f"{tmp_dir}/p{k}", part.schema).withColumn("_file", F.lit(f"part-{k}"))
        rows = own if rows is None else rows.union(own)
    assert numbered(rows, KEYS).filter("not order_ok").count() == 1
