"""Further sources, sinks and incremental / chain-subset variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.functions.address import ZERO_ADDRESS as Z
from flowlake.plans.balances import sorted_for_write
from flowlake.plans.blocks import tx_per_block
from flowlake.plans.daily_flows import all_flows, flow_from_spec, FlowSpec, yield_daily, yield_spine
from flowlake.plans.indices import daily_index
from flowlake.session import workspace_dir
from flowlake.sinks import create_view, write_table
from flowlake.sources import testdata as td, testdata_sql as tsql

from flowlake.queries.registry import register
from flowlake.queries.flows import densified_sql, ev_inc, WINDOW_START, EV_SHARES, EV_VARIANTS, EV_ZERO, _events_reader
from flowlake.queries.valuation import ROUND_VALUE_COLS, _in_list, _round, _rwa_values, _rwa_values_sql


# ------------------------------------------------------------ more sources and sinks

EV_POOL = FlowSpec("ev_pool", "zero_address", ("ev_pool",), protocol=td.EVENTS_PROTOCOL,
                   join="address", chain=td.EVENTS_CHAIN, scale=100.0,
                   value_col="amount_", from_col="owner_", to_col="recipient_")
SAVINGS_UNDERLYING = "0x00000000000000000000000000000000000000da"


@register("net_flow_pool_transfer", f"""SELECT '{td.EVENTS_CHAIN}' AS chain, t.evt_block_date AS dt,
  t.contract_address AS token_address,
  CAST(sum(CASE WHEN t.owner_ = '{Z}' THEN t.amount_ WHEN t.recipient_ = '{Z}' THEN -t.amount_ END)
    AS DOUBLE) / 100.0 AS amount
FROM ({tsql.EVENTS_POOL_LOG}) t JOIN ({tsql.EVENTS_TOKENS}) tk
  ON t.contract_address = tk.token_address AND tk.protocol = '{td.EVENTS_PROTOCOL}'
WHERE '{Z}' IN (t.owner_, t.recipient_) GROUP BY 1, 2, 3""")
def q_net_flow_pool_transfer(spark, d):
    """P-6 / P-8: zero-address flow with other column names and a protocol token join."""
    ev = td.read(spark, d, "events")
    return flow_from_spec(EV_POOL, {"ev_pool": td.events_pool_log(ev)}.__getitem__,
                          td.events_tokens(ev))


@register("savings_rate_index", f"""SELECT '{td.EVENTS_CHAIN}' AS chain, 'sky' AS protocol, contract_address,
  '{SAVINGS_UNDERLYING}' AS underlying_token_address, call_block_date AS dt,
  arg_max(CAST(output_tmp AS DOUBLE) / 1e2, (call_block_time, evt_index)) AS "index"
FROM ({tsql.EVENTS_DRIP_CALLS}) WHERE call_success = true GROUP BY contract_address, call_block_date""")
def q_savings_rate_index(spark, d):
    """P-26 / P-27: last successful drip of the day, fixed underlying token."""
    calls = td.events_drip_calls(td.read(spark, d, "events"))
    return daily_index(calls, "sky", "output_tmp", ray=100.0, chain=td.EVENTS_CHAIN,
                       underlying=F.lit(SAVINGS_UNDERLYING), date_col="call_block_date",
                       time_col="call_block_time", tiebreak="evt_index",
                       success_col="call_success")


@register("view_tx_per_block", f"""SELECT block_number, block_date, count(1) AS total_tx_per_block
FROM ({tsql.EVENTS_BLOCKS}) GROUP BY 1, 2""")
def q_view_tx_per_block(spark, d):
    """SINK-1: the model as a view, evaluated when read."""
    create_view(tx_per_block(td.events_blocks(td.read(spark, d, "events"))), "flowlake_tx_per_block")
    return spark.table("flowlake_tx_per_block")


@register("fct_rwas_sorted_table", _rwa_values_sql(True))
def q_fct_rwas_sorted_table(spark, d):
    """SINK-2 + SORT-1: fact table rebuilt in ORDER BY dt DESC, value_usd DESC."""
    path = workspace_dir(spark, "fct_rwas")
    out = write_table(spark, sorted_for_write(_rwa_values(spark, d)), path)
    return _round(out, ROUND_VALUE_COLS)


# ------------------------------------------------------------ incremental branch, chain subsets

INDEX_CHAINS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@register("densified_daily_net_incremental", densified_sql(True, WINDOW_START))
def q_densified_daily_net_incremental(spark, d):
    """P-9 incremental branch: lookback-bounded source reads, spine from
    greatest(start, today − 2), output filter dt ≥ trunc_day(now − 2 days)."""
    read, ev = _events_reader(spark, d)
    ctx = ev_inc(ev)
    flows = all_flows([EV_ZERO, EV_SHARES, EV_VARIANTS], read, td.events_tokens(ev), ctx)
    out = yield_daily(yield_spine(td.events_token_seed(ev), ctx), flows, ctx)
    return out.withColumn("daily_net_amount", F.round("daily_net_amount", 6))


@register("reserve_index_chain_subset", f"""SELECT chain, 'aave-v3' AS protocol, contract_address,
  reserve AS underlying_token_address, evt_block_date AS dt,
  arg_max(CAST(liquidityIndex AS DOUBLE) / 1e2, (evt_block_time, evt_index)) AS "index"
FROM ({tsql.ORDERS_INDEX_LOG}) WHERE chain IN ({_in_list(INDEX_CHAINS)})
GROUP BY chain, contract_address, reserve, evt_block_date""")
def q_reserve_index_chain_subset(spark, d):
    """SRC-7 + P-25: daily index of a multichain source restricted to listed chains."""
    log = td.orders_index_log(td.read(spark, d, "orders"))
    return daily_index(log, "aave-v3", "liquidityIndex", ray=100.0, chains=INDEX_CHAINS,
                       tiebreak="evt_index")
