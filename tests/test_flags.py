"""Switches between reference behaviour and the corrected reading."""

import datetime as dt
import decimal

import pytest

from flowlake.context import RunContext
from flowlake.plans.balances import stable_values
from flowlake.plans.daily_flows import FlowSpec, all_flows, yield_daily, yield_spine
from flowlake.plans.indices import daily_index, filled_token_index

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
Z = "0x" + "0" * 40
TOK, POOL, UND = "0xaaa", "0xpool", "0xund"


def _tokens(spark):
    return spark.createDataFrame(
        [("p", "yield", "eth", "erc20", TOK, "aUSDC", 2, UND, "USDC", 2, D1)],
        "protocol string, category string, chain string, asset_type string, token_address string, "
        "token_name string, token_decimals int, underlying_token_address string, "
        "underlying_token_name string, underlying_token_decimals int, start_date date")


def test_reaggregate_false_reproduces_branch_fan_out(spark):
    log = spark.createDataFrame([(D1, TOK, Z, "0x1", 100)],
                                "evt_block_date date, contract_address string, from string, to string, value long")
    specs = [FlowSpec("a", "zero_address", ("log",), chain="eth", scale=100.0),
             FlowSpec("b", "zero_address", ("log",), chain="eth", scale=100.0)]
    ctx = RunContext(as_of=D2)
    spine = yield_spine(_tokens(spark), ctx)
    merged = yield_daily(spine, all_flows(specs, {"log": log}.__getitem__, None), ctx)
    fanned = yield_daily(spine, all_flows(specs, {"log": log}.__getitem__, None, reaggregate=False), ctx)
    assert sorted(r["daily_net_amount"] for r in merged.collect()) == [0.0, 2.0]
    assert sorted(r["daily_net_amount"] for r in fanned.collect()) == [0.0, 1.0, 1.0]


def test_index_join_contract_vs_underlying_and_category_mode(spark):
    ts = dt.datetime(2024, 1, 1, 5)
    updates = spark.createDataFrame([("eth", POOL, UND, D1, ts, decimal.Decimal(2 * 10 ** 27))],
                                    "chain string, contract_address string, reserve string, "
                                    "evt_block_date date, evt_block_time timestamp, liquidityIndex decimal(38,0)")
    idx = [daily_index(updates, "p", "liquidityIndex")]
    ctx = RunContext(as_of=D2)
    by_contract = filled_token_index(_tokens(spark), idx, ctx, join_on="contract")
    by_underlying = filled_token_index(_tokens(spark), idx, ctx, join_on="underlying")
    # Reference: the aToken address never equals the pool contract → NULL index.
    assert [r["index"] for r in by_contract.orderBy("dt").collect()] == [None, None]
    assert [r["index"] for r in by_underlying.orderBy("dt").collect()] == [2.0, 2.0]

    daily = spark.createDataFrame([(D1, "eth", "yield", "p", TOK, "aUSDC", UND, "USDC", 1.0)],
                                  "dt date, blockchain string, category string, protocol string, "
                                  "token_address string, token_name string, underlying_token_address string, "
                                  "underlying_token_name string, daily_net_amount double")
    prices = spark.createDataFrame([], "blockchain string, dt date, token_address string, price_usd double")
    ref = stable_values(daily, by_underlying, prices, [], {}, category_mode="reference").first()
    carry = stable_values(daily, by_underlying, prices, [], {}, category_mode="carry").first()
    assert ref["category"] == "rwa" and carry["category"] == "yield"
    assert ref["price_usd"] == pytest.approx(2.0) and ref["value_usd"] == pytest.approx(2.0)
