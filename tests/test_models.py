"""The reference's models (default flow lists) on small reference-shaped sources."""

import datetime as dt
import decimal
import os

import pytest

from flowlake.context import RunContext
from flowlake.functions.address import ZERO_ADDRESS as Z
from flowlake.plans import defaults as D
from flowlake.plans.models import evm_stables_daily, tether_stats, tether_transfers
from flowlake.sources.catalog import Catalog
from flowlake.sources.seeds import seed_from_rows

D1, D2, D3 = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)
SUSDS = "0xa3931d71877c0e7a3148cb7eb4463524fec27fbd"
AWETH = "0x030ba81f1c18d280636f32af80b9aad02cf0854e"
SYRUP = "0x80ac24aa929eaf5013f6436cda2a7ba190f5cc0b"


def write(spark, tmp, name, rows, schema):
    rows = [tuple(decimal.Decimal(v) if isinstance(v, int) and abs(v) >= 10 ** 6 else v for v in r)
            for r in rows]
    path = os.path.join(tmp, name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return path


@pytest.fixture()
def catalog(spark, tmp_dir):
    tr = "evt_block_date date, contract_address string, from string, to string, value decimal(38,0)"
    paths = {
        "sky_ethereum.susds_evt_transfer": write(spark, tmp_dir, "susds", [
            (D1, SUSDS.upper().replace("0X", "0x"), Z, "0x01", 3 * 10 ** 18),
            (D2, SUSDS, "0x01", Z, 10 ** 18),
            (D2, SUSDS, "0x01", "0x02", 5 * 10 ** 18)], tr),
        "aave_v2_multichain.atoken_evt_mint": write(spark, tmp_dir, "mint", [
            ("ethereum", D1, AWETH, 2 * 10 ** 18, 2 * 10 ** 27)],
            "chain string, evt_block_date date, contract_address string, value decimal(38,0), index decimal(38,0)"),
        "aave_v2_multichain.atoken_evt_burn": write(spark, tmp_dir, "burn", [
            ("ethereum", D3, AWETH, 10 ** 18, 10 ** 27)],
            "chain string, evt_block_date date, contract_address string, value decimal(38,0), index decimal(38,0)"),
        "maplefinance_v2_ethereum.pool_v2_evt_transfer": write(spark, tmp_dir, "syrup", [
            (D2, SYRUP, Z, "0x05", 7 * 10 ** 6)],
            "evt_block_date date, contract_address string, owner_ string, recipient_ string, amount_ decimal(38,0)"),
    }
    return Catalog(spark, paths)


def seed(spark):
    rows = [
        ("aave-v2", "yield", "ethereum", "erc20", AWETH, "aWETH", 18, Z, "WETH", 18, D1),
        ("sky", "yield", "ethereum", "erc20", SUSDS, "sUSDS", 18, Z, "USDS", 18, D1),
        ("maple", "yield", "ethereum", "erc20", SYRUP.upper().replace("0X", "0x"), "syrupUSDC", 6, Z, "USDC", 6, D2),
    ]
    return seed_from_rows(spark, rows, "yield_tokens")


def test_evm_stables_daily_reference_flows(spark, catalog):
    specs = [s for s in D.YIELD_STABLE_FLOWS
             if all(catalog.has(x) for x in s.sources + s.burn_sources)]
    assert {s.name for s in specs} == {"aave_v2", "susds", "syrup"}
    ctx = RunContext(as_of=D3)
    out = evm_stables_daily(catalog, seed(spark), ctx, specs=specs)
    got = {(r["token_address"], r["dt"]): r["daily_net_amount"] for r in out.collect()}
    assert got[(SUSDS, D1)] == pytest.approx(3.0)
    assert got[(SUSDS, D2)] == pytest.approx(-1.0)     # the peer transfer is ignored
    assert got[(SUSDS, D3)] == 0.0
    assert got[(AWETH, D1)] == pytest.approx(1.0)      # 2 / (2e27 / 1e27)
    assert got[(AWETH, D3)] == pytest.approx(-1.0)
    assert got[(SYRUP, D2)] == pytest.approx(7.0)
    assert (SYRUP, D1) not in got                       # spine starts at start_date
    assert out.count() == 3 + 3 + 2

    inc = evm_stables_daily(catalog, seed(spark), RunContext(as_of=D3, lookback_days=1,
                                                             incremental=True), specs=specs)
    assert {r["dt"] for r in inc.collect()} == {D2, D3}


def test_duplicate_seed_rows_after_canonicalisation(spark, catalog):
    specs = [s for s in D.YIELD_STABLE_FLOWS if s.name == "syrup"]
    rows = [("maple", "yield", "ethereum", "erc20", SYRUP, "syrupUSDC", 6, Z, "USDC", 6, D2),
            ("maple", "yield", "ethereum", "erc20", SYRUP.upper().replace("0X", "0x"), "syrupUSDC", 6, Z,
             "USDC", 6, D1)]
    ctx = RunContext(as_of=D3)

    def syrup_d2(dedupe):
        out = evm_stables_daily(catalog, seed_from_rows(spark, rows, "yield_tokens"), ctx,
                                specs=specs, dedupe_tokens=dedupe)
        return [r["daily_net_amount"] for r in out.collect() if r["dt"] == D2]

    assert syrup_d2(True) == [pytest.approx(7.0)]
    # Reference behaviour: the join fans out, the spine dedup merges the rows.
    assert syrup_d2(False) == [pytest.approx(14.0)]


def test_tether_models(spark, tmp_dir):
    eth, tron = "tether_ethereum.tether_usd_evt_transfer", "tether_tron.tether_usd_evt_transfer"
    usdt_eth = list(D.TETHER_SOURCES[eth].chains)[0]
    usdt_tron = list(D.TETHER_SOURCES[tron].chains)[0]
    schema = ("evt_block_time timestamp, contract_address string, value decimal(38,0), "
              "from string, to string, evt_tx_hash string, evt_index long")
    t = dt.datetime(2024, 3, 4, 12)
    paths = {
        eth: write(spark, tmp_dir, "eth", [
            (t, usdt_eth, 50 * 10 ** 6, "a", "b", "h1", 0),
            (t, usdt_eth, 100 * 10 ** 6, "a", "c", "h1", 1),
            (t, "0xother", 10 ** 12, "a", "b", "h2", 0)], schema),
        tron: write(spark, tmp_dir, "tron", [(t, usdt_tron, 2 * 10 ** 12, "x", "y", "h3", 0)], schema),
    }
    cat = Catalog(spark, paths)
    ctx = RunContext(as_of=dt.date(2024, 3, 5))
    norm = [tether_transfers(cat, eth, ctx), tether_transfers(cat, tron, ctx)]
    assert norm[0].count() == 2
    monthly = {r["blockchain"]: r for r in tether_stats(norm, "month", ctx).collect()}
    assert monthly["ethereum"]["amount"] == pytest.approx(150.0)
    assert monthly["ethereum"]["tx_100"] == 1 and monthly["ethereum"]["tx_1000"] == 1
    assert monthly["ethereum"]["receivers"] == 2
    assert monthly["tron"]["tx_10000000"] == 1 and monthly["tron"]["period"] == dt.date(2024, 3, 1)
    weekly = tether_stats(norm, "week", ctx).collect()
    assert {r["period"] for r in weekly} == {dt.date(2024, 3, 4)}


def test_binary_addresses_become_hex_text(spark, tmp_dir):
    eth = "tether_ethereum.tether_usd_evt_transfer"
    contract = list(D.TETHER_SOURCES[eth].chains)[0]
    schema = ("evt_block_time timestamp, contract_address binary, value decimal(38,0), "
              "from binary, to binary, evt_tx_hash string, evt_index long")
    row = (dt.datetime(2024, 3, 4), bytearray.fromhex(contract[2:]), decimal.Decimal(10 ** 6),
           bytearray.fromhex("ab" * 20), bytearray.fromhex("cd" * 20), "h", 0)
    cat = Catalog(spark, {eth: write(spark, tmp_dir, "bin", [row], schema)})
    out = tether_transfers(cat, eth, RunContext(as_of=dt.date(2024, 3, 5))).first()
    assert out["from"] == "0x" + "ab" * 20 and out["to"] == "0x" + "cd" * 20
    assert out["blockchain"] == "ethereum" and out["amount"] == pytest.approx(1.0)


@pytest.mark.parametrize("form", ["binary", "checksum", "lower"])
def test_prices_of_any_address_form_give_the_same_values(spark, form):
    from flowlake.operators.pricing import price_lookup

    address = "0x00000000000000000000000000000000000000ab"
    held = spark.createDataFrame([("evm", dt.date(2024, 1, 1), address)], "blockchain string, dt date, token_address string")
    stored = {"binary": bytes.fromhex(address[2:]), "checksum": "0x" + address[2:].upper(), "lower": address}[form]
    kind = "binary" if form == "binary" else "string"
    prices = spark.createDataFrame([("evm", dt.date(2024, 1, 1), stored, 2.5)],
                                   f"blockchain string, dt date, token_address {kind}, price_usd double")
    assert [r["price_usd"] for r in price_lookup(held, prices, ["blockchain", "dt"]).collect()] == [2.5]


@pytest.mark.parametrize("kind", ["binary", "string"])
def test_address_filters_reach_the_scan(spark, tmp_dir, kind):
    from flowlake.functions.address import ZERO_ADDRESS
    from flowlake.plans.daily_flows import FlowSpec, flow_from_spec
    from flowlake.plans.models import hex_reader
    from flowlake.plans.transfers import TransferSource, normalize_transfers
    from flowlake.sources.catalog import Catalog

    def stored(a):
        return bytes.fromhex(a[2:]) if kind == "binary" else a

    token, holder = "0x" + "ab" * 20, "0x" + "cd" * 20
    rows = [(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), stored(token), stored(ZERO_ADDRESS), stored(holder), 5, b"h", 1),
            (dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), stored(token), stored(holder), stored(holder), 7, b"h", 2)]
    path = tmp_dir + "/log"
    spark.createDataFrame(rows, f"evt_block_date date, evt_block_time timestamp, contract_address {kind}, `from` {kind}, `to` {kind}, "
                                "value long, evt_tx_hash binary, evt_index long").write.parquet(path)
    read = hex_reader(Catalog(spark, {"log": path}, canonical_text={"log"}))
    spec = FlowSpec("f", "zero_address", ("log",), chain="evm", scale=1.0)
    flow = flow_from_spec(spec, read, None)
    normal = normalize_transfers(read("log"), TransferSource({token: ("evm", 0)}))
    for df in (flow, normal):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters: ["):].split("]")[0]
        assert len(pushed) > len("PushedFilters: ["), plan
    assert [r["amount"] for r in flow.collect()] == [5.0]
    assert normal.count() == 2


def test_equal_timestamps_give_one_index_in_any_layout(spark):
    from flowlake.plans.indices import daily_index

    rows = [("evm", "0xa", "0xb", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), i, (i * 7) % 40) for i in range(40)]
    df = spark.createDataFrame(rows, "chain string, contract_address string, reserve string, evt_block_date date, "
                                     "evt_block_time timestamp, evt_index long, liquidityIndex long")
    for tiebreak, expected in ((("evt_block_number", "evt_index"), (39 * 7) % 40), (None, 39)):
        got = {daily_index(df.repartition(n), "p", "liquidityIndex", ray=1.0, tiebreak=tiebreak).collect()[0]["index"] for n in (1, 3, 7)}
        assert got == {float(expected)}


def test_group_totals_above_the_bigint_range(spark):
    from flowlake.operators.stats import period_stats

    df = spark.createDataFrame([(dt.date(2024, 1, 1), "c", 6e18, "a", "b")] * 2, "dt date, blockchain string, amount double, `from` string, `to` string")
    assert period_stats(df, "month").collect()[0]["amount"] == 1.2e19


def test_a_flow_that_joins_on_chain_needs_a_chain(spark):
    from flowlake.plans.daily_flows import FlowSpec, flow_from_spec

    log = spark.createDataFrame([(dt.date(2024, 1, 1), "0xa", "mint", 5)], "evt_block_date date, contract_address string, action string, value long")
    tokens = spark.createDataFrame([("evm", "0xa", 0, dt.date(2024, 1, 1), "p")], "chain string, token_address string, token_decimals int, start_date date, protocol string")
    spec = FlowSpec("f", "action", ("log",), join="chain_address")
    with pytest.raises(ValueError):
        flow_from_spec(spec, {"log": log}.__getitem__, tokens)
