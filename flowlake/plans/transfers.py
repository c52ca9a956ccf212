"""Stablecoin transfers: per-chain normalisation and weekly / monthly stats.

A transfer source is one physical log plus a column mapping. Several chains
(or contracts) living in the same physical table are described by one source
with several entries in ``chains``: the table is scanned once with an
``IN`` filter that Parquet can push down, and the chain label and decimals
come from a CASE on the contract column.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.functions.address import address_in, address_text, binary_to_hex
from flowlake.operators.flows import union_all
from flowlake.operators.stats import period_stats

NORMALISED_COLUMNS = ["dt", "period", "blockchain", "amount", "from", "to", "tx_hash", "evt_index"]


@dataclass(frozen=True)
class TransferSource:
    """Column mapping of one transfer log.

    ``chains`` maps a contract value to (blockchain label, decimals).
    """
    chains: dict[str, tuple[str, int]]
    time_col: str = "evt_block_time"
    value_col: str = "value"
    from_col: str = "from"
    to_col: str = "to"
    tx_hash_col: str = "evt_tx_hash"
    index_col: str = "evt_index"
    contract_col: str = "contract_address"


def _case_by_contract(contract: Column, mapping: dict[str, object]) -> Column:
    expr = None
    for key, val in mapping.items():
        cond = contract == F.lit(key)
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))
    return expr


def normalize_transfers(log: DataFrame, src: TransferSource,
                        since: dt.datetime | None = None) -> DataFrame:
    """dt, period, blockchain, amount, from, to, tx_hash, evt_index.

    ``since`` is the incremental lower bound on the event time (a literal, so
    it reaches the Parquet scan as a pushed filter).
    """
    rows = log.filter(address_in(log, src.contract_col, list(src.chains)))
    if dict(log.dtypes).get(src.contract_col) == "binary":
        rows = rows.withColumn(src.contract_col, binary_to_hex(src.contract_col))
    contract = F.col(src.contract_col)
    if since is not None:
        rows = rows.filter(F.col(src.time_col) >= F.lit(since))
    chain = _case_by_contract(contract, {k: v[0] for k, v in src.chains.items()})
    decimals = _case_by_contract(contract, {k: v[1] for k, v in src.chains.items()})
    return rows.select(
        F.to_date(F.col(src.time_col)).alias("dt"),
        F.col(src.time_col).alias("period"),
        chain.alias("blockchain"),
        (F.col(src.value_col) / F.pow(F.lit(10.0), decimals)).alias("amount"),
        address_text(rows, src.from_col).alias("from"),
        address_text(rows, src.to_col).alias("to"),
        F.col(src.tx_hash_col).cast("string").alias("tx_hash"),
        F.col(src.index_col).cast("bigint").alias("evt_index"),
    )


def all_transfers(normalised: list[DataFrame], since: dt.date | None = None) -> DataFrame:
    """UNION ALL of the per-chain tables (addresses as text), optional ``dt >= since``."""
    parts = [n.select("dt", "amount", "blockchain",
                      F.col("from").cast("string").alias("from"),
                      F.col("to").cast("string").alias("to")) for n in normalised]
    out = union_all(parts)
    return out if since is None else out.filter(F.col("dt") >= F.lit(since))


def transfer_stats(normalised: list[DataFrame], unit: str, distinct: str,
                   ctx: RunContext | None = None, rsd: float = 0.01,
                   edges: list[float] | None = None) -> DataFrame:
    """Weekly (``unit='week'``, approximate distinct) or monthly (exact) statistics.

    On an incremental run the whole current period (and the previous one while
    the lookback reaches into it) is recomputed.
    """
    since = ctx.period_start(unit) if (ctx is not None and ctx.incremental) else None
    return period_stats(all_transfers(normalised, since), unit, edges=edges,
                        distinct=distinct, rsd=rsd)
