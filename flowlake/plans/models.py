"""The reference's models assembled from a source catalog, seeds and a run context.

Each function returns a lazy DataFrame; writing it (and choosing the
materialization) is the caller's job, see ``flowlake.sinks``. Within one
Spark application the models can stay lazy end to end; materialize the
daily-flow and index tables when several downstream models reuse them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.functions.address import binary_to_hex, canonical_address, raw_name
from flowlake.plans import defaults as D
from flowlake.plans.balances import detailed, rwa_values, stable_values
from flowlake.plans.daily_flows import all_flows, rwa_daily, rwa_spine, yield_daily, yield_spine
from flowlake.plans.indices import (
    daily_index, filled_token_index, index_table, market_index, vault_history, vault_universe,
)
from flowlake.plans.transfers import normalize_transfers, transfer_stats
from flowlake.sources.catalog import Catalog
from flowlake.sources.seeds import Seed, dedupe_seed

HEX_SOURCE_COLUMNS = ("contract_address", "from", "to", "owner_", "recipient_", "reserve",
                      "vault_address", "asset_address", "token_address")


# What orders events and calls of one block.
EVENT_ORDER = ("evt_block_number", "evt_index")
CALL_ORDER = ("call_block_number", "call_tx_index", "call_trace_address")


def hex_reader(catalog: Catalog):
    """Read a source with EVM address columns canonicalised (lower-case text).

    The stored form stays beside each as ``_raw_<column>`` when a filter on it can
    reach the scan: varbinary always, text if the catalog says that the source
    stores canonical text.
    """
    def read(name: str) -> DataFrame:
        df = catalog.read(name)
        out = []
        for c, kind in df.dtypes:
            if c not in HEX_SOURCE_COLUMNS or kind not in ("string", "binary"):
                out.append(F.col(c))
                continue
            out.append((canonical_address(c) if kind == "string" else binary_to_hex(c)).alias(c))
            if kind == "binary" or catalog.stores_canonical(name):
                out.append(F.col(c).alias(raw_name(c)))
        return df.select(*out)
    return read


def evm_stables_daily(catalog: Catalog, tokens: Seed, ctx: RunContext,
                      specs=None, reaggregate: bool = True,
                      dedupe_tokens: bool = True) -> DataFrame:
    """dbt_yielding_evm_stablecoins: daily net amount per yield token and day.

    ``dedupe_tokens=False`` keeps seed rows that collide after address
    canonicalisation (the source model then counts their flows twice).
    """
    if dedupe_tokens:
        tokens = dedupe_seed(tokens, ["chain", "token_address"])
    flows = all_flows(specs or D.YIELD_STABLE_FLOWS, hex_reader(catalog), tokens.broadcast(), ctx,
                      reaggregate=reaggregate)
    return yield_daily(yield_spine(tokens.df, ctx), flows, ctx)


def evm_rwas_daily(catalog: Catalog, tokens: Seed, ctx: RunContext,
                   specs=None, reaggregate: bool = True,
                   dedupe_tokens: bool = True) -> DataFrame:
    """dbt_yielding_evm_rwas: daily net amount per RWA token and day."""
    if dedupe_tokens:
        tokens = dedupe_seed(tokens, ["blockchain", "token_address"])
    flows = all_flows(specs or D.RWA_FLOWS, hex_reader(catalog), tokens.broadcast(), ctx,
                      reaggregate=reaggregate)
    return rwa_daily(rwa_spine(tokens.df, ctx), flows, ctx)


def spl_rwas_daily(catalog: Catalog, tokens: Seed, ctx: RunContext) -> DataFrame:
    """dbt_yielding_spl_rwas: the same for Solana mints (base58, case kept)."""
    spl = tokens.df.select("protocol", F.lit("solana").alias("blockchain"), "token_address",
                           "token_name", "token_decimals", "start_date")
    flows = all_flows([D.SPL_FLOW], catalog.read, Seed(spl, tokens.rows).broadcast(), ctx)
    return rwa_daily(rwa_spine(spl, ctx), flows, ctx)


def yield_indices(catalog: Catalog, tokens: Seed, ctx: RunContext,
                  join_on: str = "contract", dedupe_tokens: bool = True) -> DataFrame:
    """int_yielding_indices: market ∪ vault ∪ forward-filled daily indices."""
    if dedupe_tokens:
        tokens = dedupe_seed(tokens, ["chain", "token_address"])
    read = hex_reader(catalog)
    idx = [
        daily_index(read(D.AAVE_V2_INDEX), "aave-v2", "liquidityIndex", tiebreak=EVENT_ORDER),
        daily_index(read(D.AAVE_V3_INDEX), "aave-v3", "liquidityIndex",
                    chains=D.AAVE_V3_INDEX_CHAINS, tiebreak=EVENT_ORDER),
        daily_index(read(D.AAVE_V3_L2_INDEX), "aave-v3", "liquidityIndex",
                    chains=D.AAVE_V3_L2_INDEX_CHAINS, tiebreak=EVENT_ORDER),
        daily_index(read(D.AAVE_V3_PLASMA_INDEX), "aave-v3", "liquidityIndex", chain="plasma",
                    tiebreak=EVENT_ORDER),
        daily_index(read(D.SKY_DRIP), "sky", "chi", chain="ethereum",
                    underlying=F.lit(D.SKY_UNDERLYING), tiebreak=EVENT_ORDER),
        daily_index(read(D.MAKER_DRIP_CALL), "sky", "output_tmp", chain="ethereum",
                    underlying=F.lit(D.MAKER_UNDERLYING), date_col="call_block_date",
                    time_col="call_block_time", success_col="call_success", tiebreak=CALL_ORDER),
    ]
    filled = filled_token_index(tokens.df, idx, ctx, join_on=join_on)
    markets = market_index(read(D.COMPOUND_V3_MARKETS), tokens.broadcast())
    vaults = read(D.MORPHO_VAULTS)
    return index_table(markets, vault_history(vaults, vault_universe(vaults)), filled)


def fct_rwas(daily: DataFrame, prices: DataFrame, spl_daily: DataFrame | None = None) -> DataFrame:
    """fct_yielding_rwas: running balance, price and USD value.

    The source model leaves the Solana flows out (commented out); pass
    ``spl_daily`` to include them.
    """
    if spl_daily is not None:
        daily = daily.unionByName(spl_daily)
    return rwa_values(daily, prices, D.FIXED_PRICE_NAMES, D.PRICE_ALIASES)


def fct_stables(daily: DataFrame, indices: DataFrame, prices: DataFrame,
                category_mode: str = "reference") -> DataFrame:
    """fct_yielding_evm_stablecoins: price = fixed → index → market price."""
    return stable_values(daily, indices, prices, D.FIXED_PRICE_NAMES, D.PRICE_ALIASES,
                         category_mode=category_mode)


def fct_detailed(stables: DataFrame, rwas: DataFrame) -> DataFrame:
    """fct_yielding_detailed: both fact tables, daily total, stable-token class."""
    return detailed(stables, rwas)


def tether_transfers(catalog: Catalog, source: str, ctx: RunContext) -> DataFrame:
    """dbt_tether_<chain>: normalised USDT transfers of one chain."""
    since = None
    if ctx.incremental:
        # now() − lookback, untruncated: safe because the key holds tx hash + log index.
        since = dt.datetime.combine(ctx.as_of, dt.time()) - dt.timedelta(days=ctx.lookback_days)
    name = D.SOURCE_ALIASES.get(source, source)
    return normalize_transfers(hex_reader(catalog)(name), D.TETHER_SOURCES[name], since)


def tether_stats(normalised: list[DataFrame], unit: str, ctx: RunContext) -> DataFrame:
    """fct_tether_weekly_stats (approximate distinct) / fct_tether_monthly_stats (exact)."""
    return transfer_stats(normalised, unit, "approx" if unit == "week" else "exact", ctx)
