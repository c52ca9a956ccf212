"""Daily, market, vault and forward-filled indices (P-24…P-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowlake.plans.indices import (
    daily_index,
    filled_token_index,
    index_table,
    market_index,
    vault_history,
    vault_universe,
)
from flowlake.sources import testdata as td, testdata_sql as tsql
from flowlake.sources.seeds import seed_from_rows

from flowlake.queries.registry import register
from flowlake.queries.flows import ev_full, _yield_spine_sql


# ------------------------------------------------------------ indices

# Fixed values of the vault-universe binding: supply threshold as in the
# source model; the symbol pattern picks PURCHASE / ERROR snapshot symbols.
VAULT_MIN_SUPPLY = 1e5
VAULT_SYMBOL_PATTERN = "%R%"
# Price substitutes (token priced by another token) and fixed-price names.
PRICE_ALIASES = {"0x0000000000000000000000000000000000000003": "0x0000000000000000000000000000000000000004"}
FIXED_PRICE_NAMES = ["sUSDC-7", "aUSDT-8"]


def _ev_daily_index(ev: DataFrame, event_type: str | None) -> DataFrame:
    return daily_index(td.events_index_log(ev, event_type), protocol=td.EVENTS_PROTOCOL,
                       value="liquidityIndex", ray=100.0, tiebreak="evt_index")


def _daily_index_sql(event_type: str | None) -> str:
    return f"""SELECT chain, '{td.EVENTS_PROTOCOL}' AS protocol, contract_address,
  reserve AS underlying_token_address, evt_block_date AS dt,
  arg_max(CAST(liquidityIndex AS DOUBLE) / 1e2, (evt_block_time, evt_index)) AS "index"
FROM ({tsql.events_index_log(event_type)}) GROUP BY chain, contract_address, reserve, evt_block_date"""


# the latest reading that fell on a calendar day of the token, up to each day
FFILL_SQL = f"""WITH calendar AS ({_yield_spine_sql()}),
known AS (
  SELECT reading.* FROM ({_daily_index_sql('view')}) reading
  WHERE reading."index" IS NOT NULL AND EXISTS (
    SELECT 1 FROM calendar WHERE calendar.dt = reading.dt AND calendar.chain = reading.chain
      AND calendar.protocol = reading.protocol AND calendar.token_address = reading.contract_address))
SELECT calendar.dt, calendar.chain AS blockchain, calendar.protocol, calendar.token_address, known."index"
FROM calendar ASOF LEFT JOIN known
  ON known.chain = calendar.chain AND known.protocol = calendar.protocol
  AND known.contract_address = calendar.token_address AND calendar.dt >= known.dt"""

UNIVERSE_SQL = f"""WITH snap AS ({tsql.EVENTS_VAULTS})
SELECT blockchain, vault_address FROM snap
WHERE supply_usd >= {VAULT_MIN_SUPPLY} AND token_symbol LIKE '{VAULT_SYMBOL_PATTERN}'
  AND NOT EXISTS (SELECT 1 FROM snap later WHERE later.dt > snap.dt)
GROUP BY ALL"""

VAULT_HISTORY_SQL = f"""SELECT past.dt, past.blockchain, 'morpho-v1' AS protocol, past.vault_address,
  past.share_price_usd AS "index"
FROM ({tsql.EVENTS_VAULTS}) past
WHERE EXISTS (SELECT 1 FROM ({UNIVERSE_SQL}) chosen
              WHERE chosen.vault_address = past.vault_address AND chosen.blockchain = past.blockchain)"""

MARKET_SQL = f"""SELECT market.period AS dt, market.blockchain, 'compound-v3' AS protocol, listed.token_address,
  market.asset_address, market.supply_index AS "index"
FROM (SELECT chain, token_address, underlying_token_address
      FROM ({tsql.values_table(td.ORDERS_MARKET_SEED, tsql.YIELD_SEED_COLS, ("token_address", "underlying_token_address"))})
      WHERE protocol = 'compound-v3') listed, ({tsql.ORDERS_MARKETS}) market
WHERE listed.chain = market.blockchain AND listed.underlying_token_address = market.asset_address"""

_SERIES = 'dt, blockchain, protocol, token_address, "index"'
INDEX_UNION_SQL = f"""WITH filled AS (SELECT {_SERIES} FROM ({FFILL_SQL})),
vault AS (SELECT * RENAME (vault_address AS token_address) FROM ({VAULT_HISTORY_SQL})),
market AS (SELECT {_SERIES} FROM ({MARKET_SQL}))
FROM filled SELECT {_SERIES} UNION ALL (FROM vault SELECT {_SERIES}) UNION ALL (FROM market SELECT {_SERIES})"""


def _filled(spark, d):
    ev = td.read(spark, d, "events")
    return filled_token_index(td.events_token_seed(ev), [_ev_daily_index(ev, "view")], ev_full(ev))


def _vaults(spark, d):
    snaps = td.events_vault_snapshots(td.read(spark, d, "events"))
    return vault_history(snaps, vault_universe(snaps, VAULT_MIN_SUPPLY, VAULT_SYMBOL_PATTERN))


def _market(spark, d):
    seed = seed_from_rows(spark, td.ORDERS_MARKET_SEED, "yield_tokens")
    return market_index(td.orders_market_snapshots(td.read(spark, d, "orders")), seed.broadcast())


def _index_table(spark, d):
    return index_table(_market(spark, d), _vaults(spark, d), _filled(spark, d))


@register("last_of_day_index", _daily_index_sql(None))
def q_last_of_day_index(spark, d):
    """P-24…P-27: max_by(index, time) per (chain, contract, reserve, day)."""
    return _ev_daily_index(td.read(spark, d, "events"), None)


@register("forward_fill_index", FFILL_SQL)
def q_forward_fill_index(spark, d):
    """P-31 third branch: spine ⟕ daily index, last value ignoring NULLs per token."""
    return _filled(spark, d)


@register("latest_snapshot_universe", UNIVERSE_SQL)
def q_latest_snapshot_universe(spark, d):
    """P-29: scalar max(dt) + threshold + LIKE + DISTINCT."""
    snaps = td.events_vault_snapshots(td.read(spark, d, "events"))
    return vault_universe(snaps, VAULT_MIN_SUPPLY, VAULT_SYMBOL_PATTERN)


@register("universe_history", VAULT_HISTORY_SQL)
def q_universe_history(spark, d):
    """P-30: snapshot history of the universe (JOIN USING distinct keys == semi join)."""
    return _vaults(spark, d)


@register("market_index_by_underlying", MARKET_SQL)
def q_market_index_by_underlying(spark, d):
    """P-28: market snapshots ⋈ tokens by underlying asset and chain."""
    return _market(spark, d)


@register("index_union", INDEX_UNION_SQL)
def q_index_union(spark, d):
    """P-31: market ∪ vault ∪ forward-filled token indices."""
    return _index_table(spark, d)
