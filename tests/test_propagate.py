"""Late changes carried down equal full refreshes; untouched groups are not written again."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.operators.stats import period_stats
from flowlake.plans import models as M
from flowlake.plans.balances import with_balance
from flowlake.plans.propagate import (
    carry_tether_changes, in_periods, period_ranges, refresh_groups, refresh_running, rows_of, touched_groups, with_double,
)
from flowlake.sinks import delete_insert, write_table

D0 = dt.date(2024, 3, 1)
TRANSFERS = "dt date, period timestamp, blockchain string, amount double, `from` string, `to` string, tx_hash string, evt_index long"


def transfers(spark, places, chain):
    data = [(D0 + dt.timedelta(days=i), dt.datetime(2024, 3, 1) + dt.timedelta(days=i), chain, float(10 ** (i % 7)),
             f"a{i % 5}", f"b{i % 3}", f"tx{i}", i) for i in places]
    return spark.createDataFrame(data, TRANSFERS)


def content(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect())


def test_period_ranges_merge_neighbours():
    day = dt.date
    assert period_ranges([day(2024, 1, 1), day(2023, 12, 1), day(2024, 3, 1), day(2024, 3, 1)], "month") == [
        (day(2023, 12, 1), day(2024, 2, 1)), (day(2024, 3, 1), day(2024, 4, 1))]
    assert period_ranges([day(2024, 1, 1), day(2024, 1, 15)], "week") == [
        (day(2024, 1, 1), day(2024, 1, 8)), (day(2024, 1, 15), day(2024, 1, 22))]
    assert period_ranges([], "day") == []
    with pytest.raises(ValueError):
        period_ranges([day(2024, 1, 1)], "year")


def test_a_row_thirty_days_late_gives_the_full_refresh(spark, tmp_dir):
    log = transfers(spark, range(60), "ethereum").unionByName(transfers(spark, range(60), "bnb"))
    late = (F.col("blockchain") == "ethereum") & (F.col("evt_index").isin(25, 59))
    path = os.path.join(tmp_dir, "weekly")
    write_table(spark, period_stats(log.filter(~late), "week", distinct="exact"), path, ["period"])
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/period=*/*.parquet")}
    refresh_groups(spark, log, log.filter(late), "week", ["blockchain"],
                   lambda rows: period_stats(rows, "week", distinct="exact"), path, ["period", "blockchain"], ["period"])
    assert content(spark.read.parquet(path)) == content(period_stats(log, "week", distinct="exact"))
    kept = [f for f in before if os.path.exists(f)]
    assert len({os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in kept}) == 2     # two weeks were replaced


def test_twice_equals_once_and_nothing_changes_nothing(spark, tmp_dir):
    log, path = transfers(spark, range(20), "tron"), os.path.join(tmp_dir, "m")

    def build(rows):
        return period_stats(rows, "month", distinct="exact")

    write_table(spark, build(log.filter("evt_index < 9")), path)
    for changed in (log.filter("evt_index >= 9"), log.filter("evt_index >= 9"), log.limit(0)):
        refresh_groups(spark, log, changed, "month", ["blockchain"], build, path, ["period", "blockchain"])
        assert content(spark.read.parquet(path)) == content(build(log))


def test_null_keys_and_dates(spark):
    log = spark.createDataFrame([(D0, None, 1), (D0, "x", 2), (None, "x", 3)], "dt date, blockchain string, v int")
    groups = touched_groups(log.filter("v <> 2"), "day", ["blockchain"])
    assert [r["v"] for r in rows_of(log, groups, "day", ["blockchain"]).collect()] == [1]


def test_ranges_are_scan_filters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    log = write_table(spark, transfers(spark, range(40), "bnb"), path, ["dt"])
    groups = touched_groups(log.filter("evt_index in (3, 30)"), "week", ["blockchain"])
    plan = log.filter(in_periods(groups, "week"))._jdf.queryExecution().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert ">= 2024-03-04" in filters and "< 2024-03-11" in filters and ">= 2024-03-25" in filters
    assert log.filter(in_periods(groups, "week")).select("dt").distinct().count() == 14


def test_balances_follow_from_the_first_changed_day(spark, tmp_dir):
    days = range(50)
    data = [("eth", t, D0 + dt.timedelta(days=i), float((i * k) % 11 - 5)) for k, t in ((3, "x"), (7, "y")) for i in days]
    old = spark.createDataFrame(data, "blockchain string, token_address string, dt date, daily_net_amount double")
    series, daily_path, path = ["blockchain", "token_address"], os.path.join(tmp_dir, "daily"), os.path.join(tmp_dir, "bal")
    write_table(spark, old, daily_path, ["dt"])
    write_table(spark, with_balance(old).select(*old.columns, "balance"), path, ["dt"])
    fixed = old.filter((F.col("token_address") == "x") & F.col("dt").isin(D0 + dt.timedelta(days=18), D0 + dt.timedelta(days=33)))
    fixed = fixed.withColumn("daily_net_amount", F.col("daily_net_amount") + 100)
    daily = delete_insert(spark, fixed, daily_path, ["dt", *series], ["dt"])
    written = refresh_running(spark, daily, fixed.select("dt", *series), path, series, partition_by=["dt"])
    stored = spark.read.schema(with_double(old, "balance")).parquet(path)
    assert content(stored) == content(with_balance(daily).select(*old.columns, "balance"))
    assert written.count() == 50 - 18 and [r[0] for r in written.select("token_address").distinct().collect()] == ["x"]
    assert refresh_running(spark, daily, fixed.select("dt", *series).limit(0), path, series).count() == 0


def test_a_change_on_the_first_day_starts_from_nothing(spark, tmp_dir):
    old = spark.createDataFrame([("e", "x", D0, 1.0), ("e", "x", D0 + dt.timedelta(days=1), 2.0)],
                                "blockchain string, token_address string, dt date, daily_net_amount double")
    path = os.path.join(tmp_dir, "b")
    write_table(spark, with_balance(old).select(*old.columns, "balance"), path)
    new = old.withColumn("daily_net_amount", F.col("daily_net_amount") * 3)
    refresh_running(spark, new, new.select("dt", "blockchain", "token_address"), path, ["blockchain", "token_address"])
    assert sorted(r["balance"] for r in spark.read.parquet(path).collect()) == [3.0, 9.0]


def test_tether_tables_after_late_transfers(spark, tmp_dir):
    chains = ("ethereum", "bnb")
    for c in chains:
        write_table(spark, transfers(spark, [i for i in range(45) if i not in (4, 5, 44)], c), f"{tmp_dir}/dbt_tether_{c}", ["dt"])
    full = RunContext(as_of=D0)
    tables = [spark.read.schema(TRANSFERS).parquet(f"{tmp_dir}/dbt_tether_{c}") for c in chains]
    for unit, name in (("week", "weekly"), ("month", "monthly")):
        write_table(spark, M.tether_stats(tables, unit, full), f"{tmp_dir}/fct_tether_{name}_stats")
    out = carry_tether_changes(spark, {c: transfers(spark, [4, 5, 44], c) for c in chains}, tmp_dir)
    log = [transfers(spark, range(45), c) for c in chains]
    assert content(out["dbt_tether_bnb"]) == content(log[1])
    for unit, name in (("week", "weekly"), ("month", "monthly")):
        assert content(out[f"fct_tether_{name}_stats"]) == content(M.tether_stats(log, unit, full)), name
    assert carry_tether_changes(spark, {}, tmp_dir) == {}
