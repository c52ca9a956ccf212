"""One-scan flows equal the flows built one by one."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.plans.daily_flows import FlowSpec, all_flows, flow_from_spec
from flowlake.plans.router import LogicalSource, all_routed, flow_report, routed_flows
from flowlake.sources import deployment as dep, testdata as td

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bound(spark):
    events = td.read(spark, SF, "events")
    li = td.read(spark, SF, "lineitem")
    tables = {"events": events, "lineitem": li}

    def view(source):
        """A logical source as the table that flow_from_spec reads."""
        df = tables[source.table]
        df = df if source.where is None else df.filter(source.where)
        return df.select(*(c.alias(n) for n, c in source.columns.items()))
    return tables, view


def tokens_of(events, specs, spark):
    tokens = dep.event_tokens(events, specs)
    extra = [("aave-v2", "tpch", "0x" + "a".rjust(40, "0"), 2, dt.date(1995, 1, 1)), ("aave-v3", "tpch", "0x" + "n".rjust(40, "0"), 2, dt.date(1995, 1, 1))]
    return tokens.unionByName(spark.createDataFrame(extra, "protocol string, blockchain string, token_address string, token_decimals int, start_date date"))


@pytest.mark.parametrize("specs", [dep.YIELD_SPECS, dep.RWA_SPECS], ids=["yield", "rwa"])
@pytest.mark.parametrize("incremental", [False, True])
def test_equal_to_the_flows_one_by_one(spark, bound, specs, incremental):
    tables, view = bound
    sources = dep.sources_of(specs)
    tokens = tokens_of(tables["events"], specs, spark)
    ctx = RunContext(as_of=dt.date(2024, 1, 30), lookback_days=9, incremental=True) if incremental else None
    routed = routed_flows(specs, sources, tables.__getitem__, tokens, ctx)
    got = Counter((r["flow"], r["chain"], r["dt"], r["token_address"], round(r["amount"], 6)) for r in routed.collect())
    want = Counter()
    for spec in (s for s in specs if s.enabled):
        own = tokens if spec.kind != "lending" and spec.kind != "lending_interest" else tokens.withColumnRenamed("blockchain", "chain")
        flow = flow_from_spec(spec, lambda name: view(sources[name]), own, ctx)
        want.update((spec.name, r["chain"], r["dt"], r["token_address"], round(r["amount"], 6)) for r in flow.collect())
    assert got == want and len(got) > 100


def test_each_table_is_scanned_once(spark):
    tables = {n: td.read(spark, SF, n) for n in ("events", "lineitem")}
    tokens = tokens_of(tables["events"], dep.YIELD_SPECS, spark).limit(0)
    seed = spark.createDataFrame([], tokens.schema)
    for specs, scans in ((dep.YIELD_SPECS, 2), (dep.RWA_SPECS, 1)):
        flows = routed_flows(specs, dep.sources_of(specs), tables.__getitem__, seed)
        plan = flows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == scans


def test_filters_reach_the_scan(spark, tmp_dir):
    spark.createDataFrame([("0x1", "0x0", "0x2", 5, dt.date(2024, 1, 1))], "contract_address string, `from` string, `to` string, value long, evt_block_date date").write.parquet(f"{tmp_dir}/log")
    specs = [FlowSpec("a", "zero_address", ("s",), chain="x", scale=1.0)]
    ctx = RunContext(as_of=dt.date(2024, 1, 3), lookback_days=2, incremental=True)
    flows = routed_flows(specs, {"s": LogicalSource("log")}, lambda n: spark.read.parquet(f"{tmp_dir}/log"),
                         spark.createDataFrame([], "protocol string, chain string, token_address string, token_decimals int, start_date date"), ctx)
    plan = flows._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "evt_block_date" in pushed or "GreaterThan" in pushed


def test_a_row_may_feed_several_flows_and_disabled_flows_report_zero(spark):
    z = "0x" + "0" * 40
    log = spark.createDataFrame([(dt.date(2024, 1, 1), "0xa", z, "0xb", 700), (dt.date(2024, 1, 1), "0xa", "0xb", z, 200),
                                 (dt.date(2024, 1, 2), "0xa", None, z, 50), (None, "0xa", z, None, 1)],
                                "evt_block_date date, contract_address string, `from` string, `to` string, value long")
    specs = [FlowSpec("one", "zero_address", ("s",), chain="x", scale=100.0),
             FlowSpec("two", "zero_address", ("s",), chain="y", scale=10.0),
             FlowSpec("off", "zero_address", ("s",), chain="x", scale=1.0, enabled=False)]
    empty = spark.createDataFrame([], "protocol string, chain string, token_address string, token_decimals int, start_date date")
    flows = routed_flows(specs, {"s": LogicalSource("log")}, {"log": log}.__getitem__, empty)
    got = {(r["flow"], r["dt"]): r["amount"] for r in flows.collect()}
    assert got == {("one", dt.date(2024, 1, 1)): 5.0, ("one", dt.date(2024, 1, 2)): -0.5, ("one", None): 0.01,
                   ("two", dt.date(2024, 1, 1)): 50.0, ("two", dt.date(2024, 1, 2)): -5.0, ("two", None): 0.1}
    report = {r["flow"]: (r["enabled"], r["n_rows"], r["total"]) for r in flow_report(specs, flows).collect()}
    assert report["off"] == (False, 0, 0.0) and report["one"][1] == 3
    same = all_flows(specs, lambda n: log, empty)
    assert sorted(map(str, all_routed(specs, {"s": LogicalSource("log")}, {"log": log}.__getitem__, empty).collect())) == sorted(map(str, same.collect()))


def test_equal_names_are_refused(spark):
    spec = FlowSpec("a", "zero_address", ("s",), chain="x", scale=1.0)
    with pytest.raises(ValueError, match="differ"):
        routed_flows([spec, spec], {"s": LogicalSource("t")}, None, spark.range(0).select(F.lit("").alias("chain")))
