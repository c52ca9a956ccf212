"""The role bindings of ``testdata.py`` as SQL, for the DuckDB oracle.

Each function returns a SELECT over the pre-registered test views, written to
give bit-identical columns to its Spark counterpart.
"""

from __future__ import annotations

from flowlake.functions.address import ZERO_ADDRESS
from flowlake.sources.testdata import (
    EVENTS_CHAIN, EVENTS_PROTOCOL, ORDERS_CHAIN_TOKEN, TOKEN_NAME_PREFIXES,
)


def padded(col: str, fill: str = "0", prefix: str = "0x") -> str:
    return f"('{prefix}' || lpad(CAST({col} AS VARCHAR), {42 - len(prefix)}, '{fill}'))"


def token_name(col: str = "user_id") -> str:
    arms = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(TOKEN_NAME_PREFIXES))
    return f"((CASE {col} % {len(TOKEN_NAME_PREFIXES)} {arms} END) || '-' || CAST({col} AS VARCHAR))"


def cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS DECIMAL(38,0))"


def case_map(col: str, mapping: dict, idx: int) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v[idx])}" for k, v in mapping.items())
    return f"(CASE {col} {arms} END)"


ORDERS_LOG = f"""SELECT o_orderdate AS evt_block_time, o_orderpriority AS contract_address,
  {cents('o_totalprice')} AS value, CAST(o_custkey AS VARCHAR) AS "from",
  o_orderstatus AS "to", CAST(o_orderkey AS VARCHAR) AS evt_tx_hash,
  CAST(0 AS BIGINT) AS evt_index FROM orders"""

LINEITEM_LOG = f"""SELECT l_shipdate AS block_time, l_returnflag AS token_mint_address,
  {cents('l_extendedprice')} AS amount, CAST(l_suppkey AS VARCHAR) AS from_owner,
  CAST(l_partkey AS VARCHAR) AS to_owner, CAST(l_orderkey AS VARCHAR) AS tx_id,
  CAST(l_linenumber AS BIGINT) AS tx_index FROM lineitem"""

EVENTS_LOG = f"""SELECT '{EVENTS_CHAIN}' AS chain, CAST(ts AS DATE) AS evt_block_date,
  ts AS evt_block_time, event_id AS evt_index, {padded('user_id')} AS contract_address,
  CASE WHEN event_type = 'purchase' THEN '{ZERO_ADDRESS}' ELSE {padded('event_id', prefix='0xf')} END AS "from",
  CASE WHEN event_type = 'error' THEN '{ZERO_ADDRESS}' ELSE {padded('event_id', prefix='0xf')} END AS "to",
  {cents('value')} AS value, event_type FROM events"""

EVENTS_ACTION_LOG = f"""SELECT CAST(ts AS DATE) AS block_date, ts AS block_time,
  {padded('user_id')} AS token_mint_address,
  CASE WHEN event_type = 'purchase' THEN 'mint' WHEN event_type = 'error' THEN 'burn'
       ELSE event_type END AS action,
  {cents('value')} AS amount FROM events"""

EVENTS_TOKEN_SEED = f"""SELECT '{EVENTS_PROTOCOL}' AS protocol, 'yield' AS category,
  '{EVENTS_CHAIN}' AS chain, 'erc20' AS asset_type, {padded('user_id')} AS token_address,
  {token_name()} AS token_name, 2 AS token_decimals,
  '{ZERO_ADDRESS}' AS underlying_token_address, 'USD' AS underlying_token_name,
  2 AS underlying_token_decimals, CAST(ts AS DATE) AS start_date
  FROM events WHERE event_type = 'signup'"""


def events_index_log(event_type: str | None = None) -> str:
    where = f" WHERE event_type = '{event_type}'" if event_type else ""
    return f"""SELECT '{EVENTS_CHAIN}' AS chain, {padded('user_id')} AS contract_address,
  '{ZERO_ADDRESS}' AS reserve, CAST(ts AS DATE) AS evt_block_date, ts AS evt_block_time,
  event_id AS evt_index, {cents('value')} AS liquidityIndex FROM events{where}"""


EVENTS_VAULTS = f"""SELECT CAST(ts AS DATE) AS dt, '{EVENTS_CHAIN}' AS blockchain,
  {padded('user_id')} AS vault_address, value * 1000.0 AS supply_usd,
  upper(event_type) AS token_symbol, value AS share_price_usd FROM events"""

EVENTS_PRICES = f"""SELECT '{EVENTS_CHAIN}' AS blockchain, CAST(ts AS DATE) AS dt,
  {padded('user_id')} AS token_address, arg_max(value, ts) AS price_usd
  FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3"""

ORDERS_MARKETS = f"""SELECT CAST(o_orderdate AS DATE) AS period, o_orderpriority AS blockchain,
  {padded('lower(o_orderstatus)')} AS asset_address, o_totalprice / 1e5 AS supply_index FROM orders"""

EVENTS_BLOCKS = """SELECT CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS block_number,
  CAST(ts AS DATE) AS block_date FROM events"""

_SEED_COLS = ["protocol", "category", "chain", "asset_type", "token_address", "token_name",
              "token_decimals", "underlying_token_address", "underlying_token_name",
              "underlying_token_decimals"]

EVENTS_TOKENS = f"""SELECT {', '.join(_SEED_COLS)}, min(start_date) AS start_date
FROM ({EVENTS_TOKEN_SEED}) GROUP BY {', '.join(_SEED_COLS)}"""

EVENTS_RWA_TOKENS = f"""SELECT protocol, chain AS blockchain, token_address, token_name,
  token_decimals, start_date FROM ({EVENTS_TOKENS})"""

EVENTS_SPL_TOKENS = f"""SELECT protocol, 'solana' AS blockchain, token_address, token_name,
  token_decimals, start_date FROM ({EVENTS_TOKENS})"""

ORDERS_MINT_LOG = f"""SELECT o_orderpriority AS chain, CAST(o_orderdate AS DATE) AS evt_block_date,
  '{ORDERS_CHAIN_TOKEN}' AS contract_address,
  CASE WHEN o_orderstatus = 'F' THEN '{ZERO_ADDRESS}' ELSE {padded('o_custkey')} END AS "from",
  CASE WHEN o_orderstatus = 'O' THEN '{ZERO_ADDRESS}' ELSE {padded('o_custkey')} END AS "to",
  {cents('o_totalprice')} AS value FROM orders"""


def lineitem_lending_log(status: str) -> str:
    return f"""SELECT 'tpch' AS chain, CAST(l_shipdate AS DATE) AS evt_block_date,
  {padded('lower(l_returnflag)')} AS contract_address, {cents('l_extendedprice')} AS value,
  {cents('l_extendedprice * l_discount')} AS "balanceIncrease",
  (1.0 + l_tax) * 1e27 AS "index" FROM lineitem WHERE l_linestatus = '{status}'"""


def values_table(rows: list[tuple], cols: list[str], lower_cols: tuple[str, ...] = ()) -> str:
    """Inline rows as a SELECT … FROM (VALUES …); listed columns canonicalised with lower()."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if hasattr(v, "isoformat"):
            return f"DATE '{v.isoformat()}'"
        return str(v)
    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"lower({c}) AS {c}" if c in lower_cols else c for c in cols)
    return f"SELECT {sel} FROM (VALUES\n  {body}) AS v({', '.join(cols)})"


YIELD_SEED_COLS = _SEED_COLS + ["start_date"]
RWA_SEED_COLS = ["protocol", "blockchain", "token_address", "token_name", "token_decimals", "start_date"]

EVENTS_POOL_LOG = f"""SELECT evt_block_date, contract_address, "from" AS owner_, "to" AS recipient_,
  value AS amount_ FROM ({EVENTS_LOG})"""

EVENTS_DRIP_CALLS = f"""SELECT {padded('user_id')} AS contract_address, CAST(ts AS DATE) AS call_block_date,
  ts AS call_block_time, event_id AS evt_index, {cents('value')} AS output_tmp,
  (event_type <> 'error') AS call_success FROM events"""

ORDERS_INDEX_LOG = f"""SELECT o_orderpriority AS chain, {padded('lower(o_orderstatus)')} AS contract_address,
  '{ZERO_ADDRESS}' AS reserve, CAST(o_orderdate AS DATE) AS evt_block_date, o_orderdate AS evt_block_time,
  o_orderkey AS evt_index, {cents('o_totalprice')} AS liquidityIndex FROM orders"""
