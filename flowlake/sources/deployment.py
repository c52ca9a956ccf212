"""The default deployment's sources, bound to the test tables.

Every logical source of the flow lists is the whole ``events`` (or ``lineitem``)
table seen as that source's log; a source's tokens have their own address prefix,
so the branches stay apart.  Each view is given for Spark (``LogicalSource``) and,
from the same parts, as SQL.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.address import ZERO_ADDRESS
from flowlake.plans import defaults
from flowlake.plans.daily_flows import FlowSpec
from flowlake.plans.router import LogicalSource
from flowlake.sources import testdata as td

# Event types of the paired sources (mint tables, then burn tables).
PAIRED_TYPES = {
    "maker_ethereum.SavingsDai_evt_Deposit": "purchase",
    "maker_ethereum.SavingsDai_evt_Withdraw": "error",
    "compound_v2_ethereum.cerc20_evt_mint": "purchase",
    "compound_v2_ethereum.cerc20delegator_evt_mint": "signup",
    "compound_v2_ethereum.cerc20_evt_redeem": "error",
    "compound_v2_ethereum.cerc20delegator_evt_redeem": "view",
}
# The two chains of a multichain log, by half of the day; the chain
# whose seed rows Dinari's tokens have.
HALVES = ("arbitrum", "polygon")
DINARI_CHAIN = "arbitrum"
DECIMALS = 2


def prefix(specs: list[FlowSpec], spec: FlowSpec, source: str) -> str:
    """Address prefix of a source's tokens; a paired flow's tables share their tokens."""
    at = [s.name for s in specs].index(spec.name)
    table = list(spec.sources).index(source) if source in spec.sources and spec.kind == "zero_address" else 0
    return f"0x{at:x}{table:x}"


def _factor(spec: FlowSpec) -> int:
    """Raw units of a cent: amounts come out in currency units whatever the flow's scale."""
    return round(spec.scale / 100) if spec.scale else 1


def event_source(specs: list[FlowSpec], spec: FlowSpec, source: str) -> LogicalSource:
    et, ts = F.col("event_type"), F.col("ts")
    holder = td.padded_address(F.col("event_id"), prefix="0xf")
    value = (td.raw_cents(F.col("value")) * F.lit(Decimal(_factor(spec)))).cast("decimal(38,0)")
    columns: dict[str, Column] = {
        "evt_block_date": F.to_date(ts), "evt_block_time": ts,
        "contract_address": td.padded_address(F.col("user_id"), prefix=prefix(specs, spec, source)),
        "chain": F.when(F.hour(ts) < 12, HALVES[0]).otherwise(HALVES[1]),
        spec.from_col: F.when(et == "purchase", ZERO_ADDRESS).otherwise(holder),
        spec.to_col: F.when(et == "error", ZERO_ADDRESS).otherwise(holder),
        spec.value_col: value, spec.burn_value_col or spec.value_col: value,
    }
    where = et == PAIRED_TYPES[source] if spec.kind == "paired" else None
    return LogicalSource("events", columns, where)


def lending_source(source: str) -> LogicalSource:
    cents = td.raw_cents
    return LogicalSource("lineitem", {
        "chain": F.lit("tpch"), "evt_block_date": F.to_date("l_shipdate"),
        "contract_address": td.padded_address(F.lower(F.col("l_returnflag"))),
        "value": cents(F.col("l_extendedprice")),
        "balanceIncrease": cents(F.col("l_extendedprice") * F.col("l_discount")),
        "index": (F.lit(1.0) + F.col("l_tax")) * F.lit(1e27),
    }, F.col("l_linestatus") == ("O" if source.endswith("mint") else "F"))


def sources_of(specs: list[FlowSpec]) -> dict[str, LogicalSource]:
    out = {}
    for spec in specs:
        for source in (*spec.sources, *spec.burn_sources):
            out[source] = lending_source(source) if spec.kind.startswith("lending") else event_source(specs, spec, source)
    return out


def token_chains(spec: FlowSpec) -> tuple[str, ...]:
    if spec.name == "dinari":
        return (DINARI_CHAIN,)
    return HALVES if spec.chain is None else (spec.chain,)


def event_tokens(events: DataFrame, specs: list[FlowSpec]) -> DataFrame:
    """One token per signed-up user, source and chain: protocol, blockchain, token_address, token_decimals, start_date."""
    kinds = [(spec.protocol or spec.name, chain, prefix(specs, spec, source))
             for spec in specs if spec.join is not None and not spec.kind.startswith("lending")
             for source in (spec.sources if spec.kind == "zero_address" else spec.sources[:1]) for chain in token_chains(spec)]
    start = (events.filter(F.col("event_type") == "signup").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("start_date")))
    each = F.array(*(F.struct(F.lit(p).alias("protocol"), F.lit(c).alias("blockchain"), F.lit(x).alias("prefix")) for p, c, x in kinds))
    body = F.lpad(F.col("user_id").cast("string"), 38, "0")      # prefixes have four characters
    return (start.select("user_id", "start_date", F.explode(each).alias("k")).select(
        "k.protocol", "k.blockchain", F.concat("k.prefix", body).alias("token_address"),
        F.lit(DECIMALS).alias("token_decimals"), "start_date"))


# ---------------------------------------------------------------- the same as SQL

def branch_sql(specs: list[FlowSpec], spec: FlowSpec) -> str:
    """(flow, chain, dt, token_address, amount) of one zero-address or paired flow, by itself."""
    parts = []
    for sign, sources in ((1, spec.sources), (-1, spec.burn_sources)):
        for source in sources:
            address = f"'{prefix(specs, spec, source)}' || lpad(CAST(user_id AS VARCHAR), 38, '0')"
            chain = f"'{spec.chain}'" if spec.chain else f"CASE WHEN hour(ts) < 12 THEN '{HALVES[0]}' ELSE '{HALVES[1]}' END"
            if spec.kind == "paired":
                v, where = f"{sign}", f"event_type = '{PAIRED_TYPES[source]}'"
            else:
                v, where = "CASE event_type WHEN 'purchase' THEN 1 ELSE -1 END", "event_type IN ('purchase', 'error')"
            parts.append(f"SELECT {chain} AS chain, CAST(ts AS DATE) AS dt, {address} AS token_address, "
                         f"CAST(round(value * 100) AS DECIMAL(38,0)) * ({v}) AS v FROM events WHERE {where}")
    net = f"SELECT chain, dt, token_address, sum(v) AS v FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL"
    if spec.join is None:
        return f"SELECT '{spec.name}' AS flow, chain, dt, token_address, CAST(v AS DOUBLE) / 100 AS amount FROM ({net})"
    chains = [c for c in token_chains(spec) if spec.chain is None or c == spec.chain]
    listed = " UNION ALL ".join(f"SELECT '{c}' AS chain" for c in chains) or "SELECT '' AS chain WHERE false"
    on_chain = "listed.chain = net.chain" if spec.chain is None or spec.join == "address_fixed_chain" else "true"
    since = "AND user_start.first_day <= net.dt" if spec.since_start else ""
    return f"""SELECT '{spec.name}' AS flow, net.chain, net.dt, net.token_address, CAST(v AS DOUBLE) / 100 AS amount
FROM ({net}) net, ({listed}) listed,
  (SELECT lpad(CAST(user_id AS VARCHAR), 38, '0') AS body, CAST(min(ts) AS DATE) AS first_day
   FROM events WHERE event_type = 'signup' GROUP BY user_id) user_start
WHERE substr(net.token_address, 5) = user_start.body AND {on_chain} {since}"""


YIELD_SPECS = defaults.YIELD_STABLE_FLOWS
RWA_SPECS = defaults.RWA_FLOWS
