"""One-scan flows, 256-bit sums, stored distinct state, blocked scans, runs, order proofs,
and changes carried down the graph."""

from __future__ import annotations

import datetime as _dt
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions import wide
from flowlake.operators.blocked import balance_runs, blocked_forward_fill, blocked_running_sum, expand_runs
from flowlake.operators.ordering import numbered, order_by, read_with_places
from flowlake.operators.spine import dedup_tokens
from flowlake.operators.stats import period_start, period_stats
from flowlake.plans.balances import VALUE_COLUMNS
from flowlake.plans.daily_flows import YIELD_TOKEN_KEYS, all_flows, yield_daily, yield_spine
from flowlake.plans.distinct import add_sightings, distinct_counts, sketched_counts, store_sketches
from flowlake.plans.indices import filled_token_index
from flowlake.plans.propagate import in_periods, refresh_groups, refresh_running, rows_of, touched_groups, with_double
from flowlake.plans.router import flow_report, routed_flows
from flowlake.plans.transfers import all_transfers
from flowlake.session import workspace_dir
from flowlake.sinks import delete_insert, write_table
from flowlake.sources import deployment as dep, testdata as td, testdata_sql as tsql
from flowlake.sources.seeds import seed_from_rows

from flowlake.queries.flows import EV_SHARES, EV_VARIANTS, EV_ZERO, _events_reader, _lending_sql, _yield_daily, ev_full
from flowlake.queries.indices import FFILL_SQL, _ev_daily_index
from flowlake.queries.registry import ORACLES, register
from flowlake.queries.transfers import NORM_LINEITEM_SQL, NORM_ORDERS_SQL, _normalised
from flowlake.queries.valuation import _round, _rwa_values, _rwa_values_sql


# ------------------------------------------------------------ one-scan flow router

def _reader(spark, d):
    return lambda name: td.read(spark, d, name)


def _routed(spark, d, specs) -> DataFrame:
    tokens = dep.event_tokens(td.read(spark, d, "events"), specs)
    if any(s.kind.startswith("lending") for s in specs):
        seed = seed_from_rows(spark, td.LINEITEM_LENDING_SEED, "yield_tokens").broadcast()
        tokens = tokens.unionByName(seed.select("protocol", F.col("chain").alias("blockchain"), "token_address",
                                                "token_decimals", "start_date"))
    return routed_flows(specs, dep.sources_of(specs), _reader(spark, d), tokens)


def _branches_sql(specs) -> str:
    parts = []
    for s in specs:
        if s.kind.startswith("lending"):
            parts.append(f"SELECT '{s.name}' AS flow, chain, dt, token_address, amount "
                         f"FROM ({_lending_sql(s.protocol, s.kind == 'lending_interest')})")
        elif s.enabled:
            parts.append(dep.branch_sql(specs, s))
    return "\nUNION ALL ".join(f"({p})" for p in parts)


@register("flows_yield_all", f"SELECT flow, chain, dt, token_address, round(amount, 6) AS amount FROM ({_branches_sql(dep.YIELD_SPECS)})")
def q_flows_yield_all(spark, d):
    """SET-1 / P-9: all eleven yield flows, one scan of each physical table."""
    return _round(_routed(spark, d, dep.YIELD_SPECS), ["amount"])


@register("flows_rwa_all", f"SELECT flow, chain, dt, token_address, round(amount, 6) AS amount FROM ({_branches_sql(dep.RWA_SPECS)})")
def q_flows_rwa_all(spark, d):
    """P-11…P-22: all RWA flows of the union, flows of several tables (P-12, P-15) included."""
    return _round(_routed(spark, d, dep.RWA_SPECS), ["amount"])


_SWITCHES = ", ".join(f"('{s.name}', {str(s.enabled).lower()})" for s in dep.RWA_SPECS)


@register("flows_rwa_switches", f"""SELECT listed.flow, listed.enabled, count(f.flow) AS n_rows,
  round(coalesce(sum(f.amount), 0), 4) AS total
FROM (VALUES {_SWITCHES}) listed(flow, enabled) LEFT JOIN ({_branches_sql(dep.RWA_SPECS)}) f ON f.flow = listed.flow
GROUP BY ALL""")
def q_flows_rwa_switches(spark, d):
    """P-14 / P-16 / P-18 / P-19 / SUB-4: flows that are off, or match no token, report 0."""
    report = flow_report(dep.RWA_SPECS, _routed(spark, d, dep.RWA_SPECS))
    return report.withColumn("total", F.round("total", 4))


# ------------------------------------------------------------ 256-bit amounts

# Fixed value: the first 52 of 2^255's 77 digits; with a smaller digit after them, amounts stay below 2^255.
NEAR_TOP = str(1 << 255)[:52] + "1"


def wide_lending_log(lineitem: DataFrame) -> DataFrame:
    """lineitem as lending events with amounts just below 2^255, written as text, like event logs do."""
    tail = F.concat(F.lpad(td.raw_cents(F.col("l_extendedprice")).cast("string"), 12, "0"),
                    F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 12, "0"))
    return lineitem.select(
        F.to_date("l_shipdate").alias("dt"), td.padded_address(F.lower(F.col("l_returnflag"))).alias("token_address"),
        (F.col("l_linestatus") == "F").alias("burn"), F.concat(F.lit(NEAR_TOP), tail).alias("value"),
        td.raw_cents(F.col("l_extendedprice") * F.col("l_discount")).alias("increase"))


_B = "100000000000000000000::HUGEINT"


def _carried(name: str, source: str) -> str:
    """CTEs that carry the signed 20-digit parts p0..p3 of ``source``."""
    out, last = [], source
    for k in range(3):
        low = f"((p{k} % {_B}) + {_B}) % {_B}"
        out.append(f"{name}{k} AS (SELECT * REPLACE ({low} AS p{k}, p{k + 1} + (p{k} - ({low})) // {_B} AS p{k + 1}) FROM {last})")
        last = f"{name}{k}"
    return ",\n".join(out)


_INT256_SQL = f"""WITH event AS (
  SELECT CAST(l_shipdate AS DATE) AS dt, {tsql.padded('lower(l_returnflag)')} AS token_address,
    CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END AS sign,
    lpad('{NEAR_TOP}' || lpad(CAST({tsql.cents('l_extendedprice')} AS VARCHAR), 12, '0')
      || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 12, '0'), 80, '0') AS v,
    {tsql.cents('l_extendedprice * l_discount')}::HUGEINT AS increase
  FROM lineitem),
total AS (
  SELECT dt, token_address, count(*) AS n,
    sum(sign * substr(v, 61, 20)::HUGEINT - increase)::HUGEINT AS p0, sum(sign * substr(v, 41, 20)::HUGEINT)::HUGEINT AS p1,
    sum(sign * substr(v, 21, 20)::HUGEINT)::HUGEINT AS p2, sum(sign * substr(v, 1, 20)::HUGEINT)::HUGEINT AS p3
  FROM event GROUP BY ALL),
{_carried('first', 'total')},
flipped AS (SELECT *, p3 < 0 AS below FROM first2),
turned AS (SELECT * REPLACE (CASE WHEN below THEN -p0 ELSE p0 END AS p0, CASE WHEN below THEN -p1 ELSE p1 END AS p1,
  CASE WHEN below THEN -p2 ELSE p2 END AS p2, CASE WHEN below THEN -p3 ELSE p3 END AS p3) FROM flipped),
{_carried('again', 'turned')},
shown AS (SELECT *, ltrim(CAST(p3 AS VARCHAR) || lpad(CAST(p2 AS VARCHAR), 20, '0') || lpad(CAST(p1 AS VARCHAR), 20, '0')
  || lpad(CAST(p0 AS VARCHAR), 20, '0'), '0') AS digits FROM again2)
SELECT dt, token_address, n, CASE WHEN below THEN '-' ELSE '' END || CASE digits WHEN '' THEN '0' ELSE digits END AS net,
  round((CASE WHEN below THEN -1 ELSE 1 END) * (p3::DOUBLE * 1e60 + p2::DOUBLE * 1e40 + p1::DOUBLE * 1e20 + p0::DOUBLE) / 1e76, 9) + 0.0 AS net_scaled
FROM shown"""


@register("net_flow_int256", _INT256_SQL)
def q_net_flow_int256(spark, d):
    """FN-14 / PRJ-5: exact sums of interest-adjusted amounts near 2^255, beyond what DECIMAL holds."""
    log = wide_lending_log(td.read(spark, d, "lineitem"))
    log = log.withColumn("value", wide.from_text("value", int256=True)).withColumn("increase", wide.from_decimal("increase"))
    # sums need no carries, so events are not normalized one by one
    events = log.withColumn("w", wide.interest_adjusted("value", "increase", F.col("burn")))
    sums = events.groupBy("dt", "token_address").agg(F.count("*").alias("n"), wide.sum_limbs("w").alias("s"))
    net = sums.withColumn("s", wide.normalized("s"))
    return net.select("dt", "token_address", "n", wide.to_text("s").alias("net"),
                      (F.round(wide.to_double("s") / 1e76, 9) + F.lit(0.0)).alias("net_scaled"))      # no -0.0


# ------------------------------------------------------------ distinct state

# Fixed values of the two runs: the first sees days before RUN1_UNTIL, the second reads from RUN2_FROM.
RUN1_UNTIL = _dt.date(1998, 6, 15)
RUN2_FROM = _dt.date(1998, 5, 20)
_TRANSFERS_SQL = f"""SELECT dt, blockchain, "from", "to" FROM ({NORM_ORDERS_SQL})
UNION ALL SELECT dt, blockchain, "from", "to" FROM ({NORM_LINEITEM_SQL})"""


def _distinct_sql(unit: str, extra: str = "") -> str:
    return f"""SELECT CAST(date_trunc('{unit}', dt) AS DATE) AS period, blockchain,
  count(DISTINCT "from") AS senders, count(DISTINCT "to") AS receivers{extra}
FROM ({_TRANSFERS_SQL}) GROUP BY 1, 2"""


def _two_runs(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = all_transfers(_normalised(spark, d))
    return rows.filter(F.col("dt") < F.lit(RUN1_UNTIL)), rows.filter(F.col("dt") >= F.lit(RUN2_FROM))


@register("distinct_monthly_incremental", _distinct_sql("month"))
def q_distinct_monthly_incremental(spark, d):
    """AGG-5 / P-38: first sightings kept in a table, extended by two overlapping increments."""
    path = workspace_dir(spark, "sightings")
    first, second = _two_runs(spark, d)
    add_sightings(spark, first, "month", path)
    return distinct_counts(add_sightings(spark, second, "month", path))


@register("distinct_weekly_sketches", _distinct_sql("week", ", true AS senders_ok, true AS receivers_ok"))
def q_distinct_weekly_sketches(spark, d):
    """AGG-6 / P-37: weeks as unions of stored daily sketches, within three standard errors of 1 %
    (or two) of the exact counts."""
    path = workspace_dir(spark, "sketches")
    first, second = _two_runs(spark, d)
    store_sketches(spark, first, path)
    near = sketched_counts(store_sketches(spark, second, path), "week")
    rows = all_transfers(_normalised(spark, d))
    exact = rows.groupBy(period_start("dt", "week").alias("period"), "blockchain").agg(
        F.countDistinct("from").alias("_from"), F.countDistinct("to").alias("_to"))

    def ok(estimate: str, count: str):
        return (F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(2.0), F.col(count) * 0.03)).alias(f"{estimate}_ok")

    return exact.join(near, ["period", "blockchain"], "left").select(
        "period", "blockchain", F.col("_from").alias("senders"), F.col("_to").alias("receivers"),
        ok("senders", "_from"), ok("receivers", "_to"))


# ------------------------------------------------------------ blocked scans and runs

_BALANCE = ["blockchain", "dt", "category", "protocol", "token_name", "token_address", "daily_net_amount", "balance"]
_SERIES = ["blockchain", "token_address"]


@register("running_balance_blocked", ORACLES["running_balance"])
def q_running_balance_blocked(spark, d):
    """WIN-1: the running balance with a carry per week."""
    daily = _yield_daily(spark, d)
    out = blocked_running_sum(daily, _SERIES, "dt", "daily_net_amount", "balance", block="week")
    return _round(out.select(*_BALANCE), ["daily_net_amount", "balance"])


@register("running_balance_increment", ORACLES["running_balance"])
def q_running_balance_increment(spark, d):
    """WIN-1: a first run is stored; the second starts from its last balances and scans new days only."""
    daily = write_table(spark, _yield_daily(spark, d), workspace_dir(spark, "daily"))
    middle = daily.agg(F.date_add(F.min("dt"), (F.datediff(F.max("dt"), F.min("dt")) / 2).cast("int")).alias("m")).first()["m"]
    split = F.lit(middle or _dt.date(1970, 1, 1))
    first = blocked_running_sum(daily.filter(F.col("dt") <= split), _SERIES, "dt", "daily_net_amount", "balance", block="week")
    stored = write_table(spark, first, workspace_dir(spark, "balances"))
    start = stored.groupBy(*_SERIES).agg(F.max_by("balance", "dt").alias("balance"))
    second = blocked_running_sum(daily.filter(F.col("dt") > split), _SERIES, "dt", "daily_net_amount", "balance", block="week", start=start)
    return _round(stored.unionByName(second).select(*_BALANCE), ["daily_net_amount", "balance"])


@register("forward_fill_blocked", FFILL_SQL)
def q_forward_fill_blocked(spark, d):
    """WIN-2: the last value that is not NULL, carried from week to week."""
    ev = td.read(spark, d, "events")
    return filled_token_index(td.events_token_seed(ev), [_ev_daily_index(ev, "view")], ev_full(ev),
                              fill=partial(blocked_forward_fill, block="week"))


@register("running_balance_runs", ORACLES["running_balance"])
def q_running_balance_runs(spark, d):
    """JOIN-12 / P-1: balances as runs between changes; days are made at the end."""
    read, ev = _events_reader(spark, d)
    tokens = dedup_tokens(td.events_token_seed(ev), YIELD_TOKEN_KEYS)
    flows = all_flows([EV_ZERO, EV_SHARES, EV_VARIANTS], read, td.events_tokens(ev))
    runs = balance_runs(tokens, flows, ["chain", "token_address"], td.events_as_of(ev))
    out = expand_runs(runs).withColumnsRenamed({"chain": "blockchain", "net": "daily_net_amount"}).select(*_BALANCE)
    return _round(out, ["daily_net_amount", "balance"])


# ------------------------------------------------------------ proof of order

_ORDER = [("dt", True), ("value_usd", True)]


@register("fct_rwas_row_numbers", f"""SELECT row_number() OVER (ORDER BY dt DESC, value_usd DESC NULLS LAST) AS row_no,
  dt, value_usd, true AS order_ok FROM ({_rwa_values_sql(True)})""")
def q_fct_rwas_row_numbers(spark, d):
    """SORT-1: the sorted table read back with global row numbers and a check of every neighbouring pair."""
    values = _round(_rwa_values(spark, d), ["balance", "value_usd"]).select(*VALUE_COLUMNS)
    path = workspace_dir(spark, "fct_rwas_numbered")
    written = write_table(spark, values.orderBy(*order_by(_ORDER)), path)
    return numbered(read_with_places(spark, path, written.schema), _ORDER).select("row_no", "dt", "value_usd", "order_ok")


# ------------------------------------------------------------ changes carried down

# Transfers of LATE_MONTH_DAYS and of the last days arrive after the first run, and so do
# the events of LATE_EVENT_DAYS, weeks before the last day of their table.
LATE_MONTH_DAYS = (_dt.date(1995, 3, 6), _dt.date(1995, 3, 9))
NEW_TRANSFERS_FROM = _dt.date(1998, 7, 20)
LATE_EVENT_DAYS = (_dt.date(2024, 1, 3), _dt.date(2024, 1, 4))


def _between(col: str, days: tuple):
    return F.col(col).between(F.lit(days[0]), F.lit(days[1]))


@register("propagated_monthly_stats", ORACLES["stats_monthly_exact"])
def q_propagated_monthly_stats(spark, d):
    """SRC-6 / SINK-9: transfers years late; only the (month, chain) groups they touch are counted again."""
    log = write_table(spark, all_transfers(_normalised(spark, d)), workspace_dir(spark, "log"))
    arrives = _between("dt", LATE_MONTH_DAYS) | (F.col("dt") >= F.lit(NEW_TRANSFERS_FROM))
    path = workspace_dir(spark, "propagated-stats")
    write_table(spark, period_stats(log.filter(~arrives), "month", distinct="exact"), path)
    refresh_groups(spark, log, log.filter(arrives), "month", ["blockchain"],
                   lambda rows: period_stats(rows, "month", distinct="exact"), path, ["period", "blockchain"])
    return spark.read.parquet(path)


@register("propagated_balances", ORACLES["running_balance"])
def q_propagated_balances(spark, d):
    """SRC-6 / WIN-1: late events change daily nets; balances follow from the first changed day on."""
    read, ev = _events_reader(spark, d)
    specs, tokens, seed = [EV_ZERO, EV_SHARES, EV_VARIANTS], td.events_tokens(ev), td.events_token_seed(ev)
    late = _between("evt_block_date", LATE_EVENT_DAYS)
    spine = yield_spine(seed, ev_full(ev))

    def nets(flows):
        return yield_daily(spine, flows, ev_full(ev))

    daily_path, path = workspace_dir(spark, "propagated-daily"), workspace_dir(spark, "propagated-balances")
    first = write_table(spark, nets(all_flows(specs, lambda n: read(n).filter(~late), tokens)), daily_path, ["dt"])
    write_table(spark, blocked_running_sum(first, _SERIES, "dt", "daily_net_amount", "balance", block="week"), path, ["dt"])

    arrived = all_flows(specs, lambda n: read(n).filter(late), tokens).withColumnRenamed("chain", "blockchain")
    changed = write_table(spark, touched_groups(arrived, "day", _SERIES), workspace_dir(spark, "changed"))
    flows = all_flows(specs, read, tokens)
    again = rows_of(nets(flows.filter(in_periods(changed, "day"))), changed, "day", _SERIES)
    daily = delete_insert(spark, again, daily_path, ["dt", *_SERIES], ["dt"])
    refresh_running(spark, daily, changed.withColumnRenamed("period", "dt"), path, _SERIES, block="week", partition_by=["dt"])
    out = spark.read.schema(with_double(daily, "balance")).parquet(path)
    return _round(out.select(*_BALANCE), ["daily_net_amount", "balance"])
