"""Transfer normalisation and period statistics (P-35…P-38)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlake.plans.transfers import normalize_transfers, transfer_stats, TransferSource
from flowlake.sources import testdata as td, testdata_sql as tsql

from flowlake.queries.registry import register


# ------------------------------------------------------------ transfers

ORDERS_SOURCE = TransferSource(chains=td.ORDER_CHAINS)
LINEITEM_SOURCE = TransferSource(
    chains=td.LINEITEM_MINTS, time_col="block_time", value_col="amount",
    from_col="from_owner", to_col="to_owner", tx_hash_col="tx_id",
    index_col="tx_index", contract_col="token_mint_address")


def _normalised(spark: SparkSession, d: str) -> list[DataFrame]:
    return [
        normalize_transfers(td.orders_transfer_log(td.read(spark, d, "orders")), ORDERS_SOURCE),
        normalize_transfers(td.lineitem_solana_log(td.read(spark, d, "lineitem")), LINEITEM_SOURCE),
    ]


def _normalise_sql(log_sql: str, src: TransferSource) -> str:
    c = src.contract_col
    keys = ", ".join(f"'{k}'" for k in src.chains)
    return f"""SELECT CAST({src.time_col} AS DATE) AS dt, {src.time_col} AS period,
  {tsql.case_map(c, src.chains, 0)} AS blockchain,
  {src.value_col} / power(10.0, {tsql.case_map(c, src.chains, 1)}) AS amount,
  CAST("{src.from_col}" AS VARCHAR) AS "from", CAST("{src.to_col}" AS VARCHAR) AS "to",
  CAST({src.tx_hash_col} AS VARCHAR) AS tx_hash, CAST({src.index_col} AS BIGINT) AS evt_index
FROM ({log_sql}) WHERE {c} IN ({keys})"""


NORM_ORDERS_SQL = _normalise_sql(tsql.ORDERS_LOG, ORDERS_SOURCE)
NORM_LINEITEM_SQL = _normalise_sql(tsql.LINEITEM_LOG, LINEITEM_SOURCE)


def _stats_sql(unit: str) -> str:
    edges = [100, 1000, 10000, 100000, 1000000]
    conds = [("100", "amount < 100")]
    for lo, hi in zip(edges, edges[1:]):
        conds.append((str(hi), f"amount >= {lo} AND amount < {hi}"))
    conds.append(("10000000", "amount >= 1000000"))
    dec = "DECIMAL(38,6)"
    tx = ",\n  ".join(f"count(*) FILTER (WHERE {c}) AS tx_{l}" for l, c in conds)
    amt = ",\n  ".join(f"CAST(sum(CAST(amount AS {dec})) FILTER (WHERE {c}) AS DOUBLE) AS amt_{l}"
                       for l, c in conds)
    return f"""WITH t AS (
  SELECT dt, amount, blockchain, "from", "to" FROM ({NORM_ORDERS_SQL})
  UNION ALL
  SELECT dt, amount, blockchain, "from", "to" FROM ({NORM_LINEITEM_SQL}))
SELECT CAST(date_trunc('{unit}', dt) AS DATE) AS period, blockchain,
  CAST(sum(CAST(amount AS {dec})) AS DOUBLE) AS amount, count(*) AS txs,
  count(DISTINCT "from") AS senders, count(DISTINCT "to") AS receivers,
  {tx},
  {amt}
FROM t GROUP BY 1, 2"""


@register("transfer_normalize", NORM_ORDERS_SQL)
def q_transfer_normalize(spark, d):
    """P-35: five contracts of one orders log → normalised transfers."""
    return _normalised(spark, d)[0]


@register("transfer_normalize_alt_schema", NORM_LINEITEM_SQL)
def q_transfer_normalize_alt_schema(spark, d):
    """P-36: the Solana-style column mapping."""
    return _normalised(spark, d)[1]


@register("stats_monthly_exact", _stats_sql("month"))
def q_stats_monthly_exact(spark, d):
    """P-38: union of chains → monthly stats with exact distinct counts."""
    return transfer_stats(_normalised(spark, d), "month", "exact")


@register("stats_weekly_approx")
def q_stats_weekly_approx(spark, d):
    """P-37: weekly stats, HLL++ distinct counts at 1 % standard error.

    No SQL oracle (sketches differ between engines); tests compare with the
    exact counts within the error bound.
    """
    return transfer_stats(_normalised(spark, d), "week", "approx", rsd=0.01)
