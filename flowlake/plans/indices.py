"""Yield indices: last index of each day, market and vault indices, forward fill.

The final table is the union of three branches: market supply indices joined
to tokens by their underlying asset, vault share prices for the vault
universe, and a per-token daily series on the calendar spine whose gaps are
forward-filled from the last known reserve / savings-rate index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.operators.flows import union_all
from flowlake.operators.joins import semi_join
from flowlake.operators.series import forward_fill, last_of_day
from flowlake.plans.daily_flows import yield_spine

INDEX_COLUMNS = ["chain", "protocol", "contract_address", "underlying_token_address", "dt", "index"]


def daily_index(updates: DataFrame, protocol: str, value: str, ray: float = 1e27,
                chain: str | None = None, chains: list[str] | None = None,
                underlying: str | Column = "reserve", date_col: str = "evt_block_date",
                time_col: str = "evt_block_time", tiebreak: str | tuple[str, ...] | None = None,
                success_col: str | None = None) -> DataFrame:
    """max_by(value / ray, time) per (chain, contract, underlying, day).

    ``chain``: literal chain (single-chain source); ``chains``: keep only these
    chains of a multichain source; ``underlying``: a column name or a literal
    column (savings-rate contracts have a fixed underlying token);
    ``success_col``: keep only successful calls (call traces); ``tiebreak``: columns
    that order updates of one time, as far as the source has them. The value itself
    decides last, so equal times give the same index in any layout.
    """
    rows = updates
    if chains:
        rows = rows.filter(F.col("chain").isin(*chains))
    if success_col:
        rows = rows.filter(F.col(success_col) == F.lit(True))
    und = F.col(underlying) if isinstance(underlying, str) else underlying
    cols = [
        (F.lit(chain) if chain is not None else F.col("chain")).alias("chain"),
        F.col("contract_address"), und.alias("underlying_token_address"),
        F.col(date_col).alias("dt"), F.col(time_col).alias("_t"),
        (F.col(value).cast("double") / F.lit(ray)).alias("_v"),
    ]
    order = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or ())
    cols.append(F.struct(*[F.col(c) for c in order if c in rows.columns],
                         F.col(value).cast("double").alias("_value")).alias("_tb"))
    keyed = rows.select(*cols)
    out = last_of_day(keyed, ["chain", "contract_address", "underlying_token_address", "dt"],
                      "_v", "_t", tiebreak="_tb", out="index")
    return out.withColumn("protocol", F.lit(protocol)).select(*INDEX_COLUMNS)


def market_index(markets: DataFrame, tokens: DataFrame, protocol: str = "compound-v3") -> DataFrame:
    """P-28: market snapshot ⋈ tokens on (underlying asset, chain) for one protocol.

    Fans out when several tokens share an underlying (as the source does).
    """
    tk = tokens.filter(F.col("protocol") == protocol).select(
        F.col("underlying_token_address").alias("asset_address"),
        F.col("chain").alias("blockchain"), "token_address")
    return (markets.join(tk, ["asset_address", "blockchain"], "inner")
            .select(F.col("period").alias("dt"), "blockchain", F.lit(protocol).alias("protocol"),
                    "token_address", "asset_address", F.col("supply_index").alias("index")))


def vault_universe(snapshots: DataFrame, min_supply: float = 1e5,
                   symbol_pattern: str = "%USD%") -> DataFrame:
    """P-29: vaults at the latest snapshot date with supply ≥ min and a matching symbol.

    ``max(dt)`` is a global aggregate – exactly one row – so the semi join
    against it is a broadcast by construction.
    """
    latest = snapshots.agg(F.max("dt").alias("dt"))
    at_latest = snapshots.join(F.broadcast(latest), "dt", "left_semi")
    return (at_latest.filter((F.col("supply_usd") >= F.lit(min_supply))
                             & F.col("token_symbol").like(symbol_pattern))
            .select("blockchain", "vault_address").distinct())


def vault_history(snapshots: DataFrame, universe: DataFrame,
                  protocol: str = "morpho-v1") -> DataFrame:
    """P-30: share-price history of the universe vaults (semi join, no fan-out)."""
    return (semi_join(snapshots, universe, ["blockchain", "vault_address"])
            .select("dt", "blockchain", F.lit(protocol).alias("protocol"), "vault_address",
                    F.col("share_price_usd").alias("index")))


def filled_token_index(tokens: DataFrame, indices: list[DataFrame], ctx: RunContext,
                       join_on: str = "contract", fill=forward_fill) -> DataFrame:
    """P-31 third branch: token × day spine ⟕ daily indices, forward-filled per token.

    ``join_on='contract'`` matches the token address with the index source's
    contract (the reference's join); ``'underlying'`` matches the token's
    underlying with the index's reserve instead.  ``fill`` may be
    ``blocked_forward_fill``, which spreads a long series over several tasks.
    """
    spine = yield_spine(tokens, RunContext(as_of=ctx.as_of))
    idx = union_all([i.select(*INDEX_COLUMNS) for i in indices])
    if join_on == "contract":
        right = idx.select("dt", "protocol", "chain", F.col("contract_address").alias("token_address"),
                           F.col("index").alias("_i"))
        keys = ["dt", "protocol", "chain", "token_address"]
    elif join_on == "underlying":
        right = idx.select("dt", "protocol", "chain", "underlying_token_address",
                           F.col("index").alias("_i"))
        keys = ["dt", "protocol", "chain", "underlying_token_address"]
    else:
        raise ValueError("join_on must be 'contract' or 'underlying'")
    joined = spine.join(right, keys, "left")
    filled = fill(joined, ["chain", "protocol", "token_address"], "dt", "_i", out="index")
    return filled.select("dt", F.col("chain").alias("blockchain"), "protocol", "token_address", "index")


def index_table(market: DataFrame | None, vaults: DataFrame | None,
                filled: DataFrame) -> DataFrame:
    """P-31: market ∪ vault ∪ filled series as (dt, blockchain, protocol, token_address, index)."""
    parts = []
    if market is not None:
        parts.append(market.select("dt", "blockchain", "protocol", "token_address", "index"))
    if vaults is not None:
        parts.append(vaults.select("dt", "blockchain", "protocol",
                                   F.col("vault_address").alias("token_address"), "index"))
    parts.append(filled)
    return union_all(parts)
