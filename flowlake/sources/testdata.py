"""Role bindings: the driver's test tables presented as the reference's sources.

The reference reads blockchain event logs; the test data is a TPC-H-like
schema plus an ``events`` table. Each binding below is a pure projection
(it fuses into the scan stage and keeps column pruning / filter pushdown):

* ``orders`` → a multi-token transfer log: the priority plays the contract
  address, the order total (in cents) the raw amount.
* ``lineitem`` → a Solana-style transfer table (owner columns, tx id/index).
* ``events`` → the token world: each user is a token, ``purchase`` rows
  mint (from the zero address), ``error`` rows burn (to the zero address),
  every other row is a peer transfer; ``signup`` rows form the token seed
  (first signup = start date); values double as index and price readings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.address import ZERO_ADDRESS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixed values of the bindings.
ORDERS_AS_OF = dt.date(2001, 8, 1)
EVENTS_CHAIN = "evm"
EVENTS_PROTOCOL = "events"
TOKEN_NAME_PREFIXES = ["sUSDC", "aUSDT", "sUSDe", "stUSDS", "USD0pp", "sDAI", "yVLT"]
ORDER_CHAINS = {
    "1-URGENT": ("urgent", 2),
    "2-HIGH": ("high", 2),
    "3-MEDIUM": ("medium", 2),
    "4-NOT SPECIFIED": ("unspecified", 2),
    "5-LOW": ("low", 3),
}
LINEITEM_MINTS = {"A": ("lineitem", 2), "N": ("lineitem", 2), "R": ("lineitem", 2)}
ORDERS_CHAIN_TOKEN = "0x0000000000000000000000000000000000ab1e50"
# Seed-like token table of the orders world: one token per priority "chain",
# hex case varies (canonicalised on read), the last one starts in the future.
ORDERS_RWA_SEED = [
    ("tpch", "1-URGENT", "0x0000000000000000000000000000000000AB1E50", "TPCH-U", 2, dt.date(1995, 1, 1)),
    ("tpch", "2-HIGH", "0x0000000000000000000000000000000000ab1e50", "TPCH-H", 2, dt.date(1996, 6, 1)),
    ("tpch", "3-MEDIUM", "0x0000000000000000000000000000000000Ab1E50", "TPCH-M", 3, dt.date(1997, 1, 1)),
    ("tpch", "4-NOT SPECIFIED", "0x0000000000000000000000000000000000ab1e50", "TPCH-N", 2, dt.date(1999, 12, 31)),
    ("tpch", "5-LOW", "0x0000000000000000000000000000000000AB1E50", "TPCH-L", 4, dt.date(2002, 1, 1)),
]
# Lending tokens of the lineitem world: one aToken per return flag.
LINEITEM_LENDING_SEED = [
    ("aave-v2", "yield", "tpch", "erc20", "0x000000000000000000000000000000000000000A", "aTPCH-A", 2,
     "0x00000000000000000000000000000000000000f0", "TPCH", 2, dt.date(1995, 1, 1)),
    ("aave-v3", "yield", "tpch", "erc20", "0x000000000000000000000000000000000000000n", "aTPCH-N", 2,
     "0x00000000000000000000000000000000000000f0", "TPCH", 2, dt.date(1995, 1, 1)),
    ("aave-v3", "yield", "tpch", "erc20", "0x000000000000000000000000000000000000000R", "aTPCH-R", 2,
     "0x00000000000000000000000000000000000000f0", "TPCH", 2, dt.date(1995, 1, 1)),
]
# Market tokens of the orders world: two tokens share underlying "f" on one
# chain (fan-out), one token belongs to another protocol (filtered out).
ORDERS_MARKET_SEED = [
    ("compound-v3", "yield", "1-URGENT", "erc20", "0x00000000000000000000000000000000000000C1", "cF-1", 6,
     "0x000000000000000000000000000000000000000F", "F", 6, dt.date(1995, 1, 1)),
    ("compound-v3", "yield", "1-URGENT", "erc20", "0x00000000000000000000000000000000000000C2", "cF-2", 6,
     "0x000000000000000000000000000000000000000f", "F", 6, dt.date(1995, 1, 1)),
    ("compound-v3", "yield", "2-HIGH", "erc20", "0x00000000000000000000000000000000000000C3", "cO-2", 6,
     "0x000000000000000000000000000000000000000o", "O", 6, dt.date(1995, 1, 1)),
    ("compound-v3", "yield", "3-MEDIUM", "erc20", "0x00000000000000000000000000000000000000C4", "cP-3", 6,
     "0x000000000000000000000000000000000000000p", "P", 6, dt.date(1995, 1, 1)),
    ("aave-v3", "yield", "1-URGENT", "erc20", "0x00000000000000000000000000000000000000C5", "aO-1", 6,
     "0x000000000000000000000000000000000000000o", "O", 6, dt.date(1995, 1, 1)),
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_of(events: DataFrame) -> dt.date:
    """The last event day: "today" of the events world (an empty table has none)."""
    return events.agg(F.max(F.to_date("ts")).alias("d")).first()["d"] or dt.date(1970, 1, 1)


def padded_address(col: Column, fill: str = "0", prefix: str = "0x") -> Column:
    """An id rendered as a 40-character address-like string."""
    return F.concat(F.lit(prefix), F.lpad(col.cast("string"), 42 - len(prefix), fill))


def user_token(col: Column) -> Column:
    return padded_address(col)


def token_name(user_id: Column) -> Column:
    """Name pattern per user so the stable-token classifier sees every arm."""
    expr = None
    for i, prefix in enumerate(TOKEN_NAME_PREFIXES):
        cond = (user_id % len(TOKEN_NAME_PREFIXES)) == i
        expr = F.when(cond, F.lit(prefix)) if expr is None else expr.when(cond, F.lit(prefix))
    return F.concat(expr, F.lit("-"), user_id.cast("string"))


def raw_cents(col: Column) -> Column:
    """An amount as integer cents, rounded half-up (the raw-unit column of a log).

    round → BIGINT → DECIMAL keeps the decimal long-backed; a direct
    double → DECIMAL cast goes through BigDecimal for every row.
    """
    return F.round(col * F.lit(100)).cast("bigint").cast("decimal(38,0)")


def orders_transfer_log(orders: DataFrame) -> DataFrame:
    """orders as a USDT-style log: evt_block_time, contract_address, value, from, to, evt_tx_hash, evt_index."""
    return orders.select(
        F.col("o_orderdate").alias("evt_block_time"),
        F.col("o_orderpriority").alias("contract_address"),
        raw_cents(F.col("o_totalprice")).alias("value"),
        F.col("o_custkey").cast("string").alias("from"),
        F.col("o_orderstatus").alias("to"),
        F.col("o_orderkey").cast("string").alias("evt_tx_hash"),
        F.lit(0).cast("bigint").alias("evt_index"),
    )


def lineitem_solana_log(lineitem: DataFrame) -> DataFrame:
    """lineitem as a Solana transfer table: block_time, token_mint_address, amount, owners, tx_id, tx_index."""
    return lineitem.select(
        F.col("l_shipdate").alias("block_time"),
        F.col("l_returnflag").alias("token_mint_address"),
        raw_cents(F.col("l_extendedprice")).alias("amount"),
        F.col("l_suppkey").cast("string").alias("from_owner"),
        F.col("l_partkey").cast("string").alias("to_owner"),
        F.col("l_orderkey").cast("string").alias("tx_id"),
        F.col("l_linenumber").cast("bigint").alias("tx_index"),
    )


def events_transfer_log(events: DataFrame) -> DataFrame:
    """events as an ERC-20 transfer log of per-user tokens."""
    holder = padded_address(F.col("event_id"), prefix="0xf")
    et = F.col("event_type")
    return events.select(
        F.lit(EVENTS_CHAIN).alias("chain"),
        F.to_date("ts").alias("evt_block_date"),
        F.col("ts").alias("evt_block_time"),
        F.col("event_id").alias("evt_index"),
        user_token(F.col("user_id")).alias("contract_address"),
        F.when(et == "purchase", F.lit(ZERO_ADDRESS)).otherwise(holder).alias("from"),
        F.when(et == "error", F.lit(ZERO_ADDRESS)).otherwise(holder).alias("to"),
        raw_cents(F.col("value")).alias("value"),
        et.alias("event_type"),
    )


def events_action_log(events: DataFrame) -> DataFrame:
    """events as an action-labelled (SPL-style) log: mint / burn / other."""
    et = F.col("event_type")
    return events.select(
        F.to_date("ts").alias("block_date"),
        F.col("ts").alias("block_time"),
        user_token(F.col("user_id")).alias("token_mint_address"),
        F.when(et == "purchase", "mint").when(et == "error", "burn").otherwise(et).alias("action"),
        raw_cents(F.col("value")).alias("amount"),
    )


def events_token_seed(events: DataFrame) -> DataFrame:
    """Yield-token seed rows (one per signup, so the 7-column dedup has work to do)."""
    uid = F.col("user_id")
    return events.filter(F.col("event_type") == "signup").select(
        F.lit(EVENTS_PROTOCOL).alias("protocol"),
        F.lit("yield").alias("category"),
        F.lit(EVENTS_CHAIN).alias("chain"),
        F.lit("erc20").alias("asset_type"),
        user_token(uid).alias("token_address"),
        token_name(uid).alias("token_name"),
        F.lit(2).alias("token_decimals"),
        F.lit(ZERO_ADDRESS).alias("underlying_token_address"),
        F.lit("USD").alias("underlying_token_name"),
        F.lit(2).alias("underlying_token_decimals"),
        F.to_date("ts").alias("start_date"),
    )


def events_tokens(events: DataFrame) -> DataFrame:
    """The seed deduplicated on every column but start_date (one row per user)."""
    seed = events_token_seed(events)
    cols = [c for c in seed.columns if c != "start_date"]
    return seed.groupBy(*cols).agg(F.min("start_date").alias("start_date"))


def events_rwa_tokens(events: DataFrame) -> DataFrame:
    """The same tokens in RWA seed shape: protocol, blockchain, token_address, token_name, token_decimals, start_date."""
    return events_tokens(events).select("protocol", F.col("chain").alias("blockchain"),
                                        "token_address", "token_name", "token_decimals",
                                        "start_date")


def events_spl_tokens(events: DataFrame) -> DataFrame:
    """The same tokens in SPL seed shape (chain fixed to 'solana')."""
    return events_tokens(events).select("protocol", F.lit("solana").alias("blockchain"),
                                        "token_address", "token_name", "token_decimals",
                                        "start_date")


def orders_mint_log(orders: DataFrame) -> DataFrame:
    """orders as a multichain ERC-20 log: F orders mint, O orders burn, P are peer transfers."""
    holder = padded_address(F.col("o_custkey"))
    st = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderpriority").alias("chain"),
        F.to_date("o_orderdate").alias("evt_block_date"),
        F.lit(ORDERS_CHAIN_TOKEN).alias("contract_address"),
        F.when(st == "F", F.lit(ZERO_ADDRESS)).otherwise(holder).alias("from"),
        F.when(st == "O", F.lit(ZERO_ADDRESS)).otherwise(holder).alias("to"),
        raw_cents(F.col("o_totalprice")).alias("value"),
    )


def lineitem_lending_log(lineitem: DataFrame, linestatus: str) -> DataFrame:
    """lineitem rows of one status as aToken mint (O) or burn (F) events."""
    return lineitem.filter(F.col("l_linestatus") == linestatus).select(
        F.lit("tpch").alias("chain"),
        F.to_date("l_shipdate").alias("evt_block_date"),
        padded_address(F.lower(F.col("l_returnflag"))).alias("contract_address"),
        raw_cents(F.col("l_extendedprice")).alias("value"),
        raw_cents(F.col("l_extendedprice") * F.col("l_discount")).alias("balanceIncrease"),
        ((F.lit(1.0) + F.col("l_tax")) * F.lit(1e27)).alias("index"),
    )


def events_pool_log(events: DataFrame) -> DataFrame:
    """events as a pool transfer log with owner_ / recipient_ / amount_ columns."""
    log = events_transfer_log(events)
    return log.select("evt_block_date", "contract_address", F.col("from").alias("owner_"),
                      F.col("to").alias("recipient_"), F.col("value").alias("amount_"))


def events_drip_calls(events: DataFrame) -> DataFrame:
    """events as savings-rate drip call traces; 'error' rows are failed calls."""
    return events.select(
        user_token(F.col("user_id")).alias("contract_address"),
        F.to_date("ts").alias("call_block_date"),
        F.col("ts").alias("call_block_time"),
        F.col("event_id").alias("evt_index"),
        raw_cents(F.col("value")).alias("output_tmp"),
        (F.col("event_type") != "error").alias("call_success"),
    )


def orders_index_log(orders: DataFrame) -> DataFrame:
    """orders as multichain reserve-index updates (chain = priority, contract = status)."""
    return orders.select(
        F.col("o_orderpriority").alias("chain"),
        padded_address(F.lower(F.col("o_orderstatus"))).alias("contract_address"),
        F.lit(ZERO_ADDRESS).alias("reserve"),
        F.to_date("o_orderdate").alias("evt_block_date"),
        F.col("o_orderdate").alias("evt_block_time"),
        F.col("o_orderkey").alias("evt_index"),
        raw_cents(F.col("o_totalprice")).alias("liquidityIndex"),
    )


def events_index_log(events: DataFrame, event_type: str | None = None) -> DataFrame:
    """events as reserve-index updates: chain, contract_address, reserve, date, time, liquidityIndex."""
    rows = events if event_type is None else events.filter(F.col("event_type") == event_type)
    return rows.select(
        F.lit(EVENTS_CHAIN).alias("chain"),
        user_token(F.col("user_id")).alias("contract_address"),
        F.lit(ZERO_ADDRESS).alias("reserve"),
        F.to_date("ts").alias("evt_block_date"),
        F.col("ts").alias("evt_block_time"),
        F.col("event_id").alias("evt_index"),
        raw_cents(F.col("value")).alias("liquidityIndex"),
    )


def events_vault_snapshots(events: DataFrame) -> DataFrame:
    """events as vault snapshots: dt, blockchain, vault_address, supply_usd, token_symbol, share_price_usd."""
    return events.select(
        F.to_date("ts").alias("dt"),
        F.lit(EVENTS_CHAIN).alias("blockchain"),
        user_token(F.col("user_id")).alias("vault_address"),
        (F.col("value") * F.lit(1000.0)).alias("supply_usd"),
        F.upper(F.col("event_type")).alias("token_symbol"),
        F.col("value").alias("share_price_usd"),
    )


def events_daily_prices(events: DataFrame) -> DataFrame:
    """events 'view' rows as a daily price table: blockchain, dt, token_address, price_usd."""
    return (events.filter(F.col("event_type") == "view")
            .groupBy(F.lit(EVENTS_CHAIN).alias("blockchain"), F.to_date("ts").alias("dt"),
                     user_token(F.col("user_id")).alias("token_address"))
            .agg(F.max_by(F.col("value"), F.col("ts")).alias("price_usd")))


def orders_market_snapshots(orders: DataFrame) -> DataFrame:
    """orders as market snapshots: period, blockchain, asset_address, supply_index."""
    return orders.select(
        F.to_date("o_orderdate").alias("period"),
        F.col("o_orderpriority").alias("blockchain"),
        padded_address(F.lower(F.col("o_orderstatus"))).alias("asset_address"),
        (F.col("o_totalprice") / F.lit(1e5)).alias("supply_index"),
    )


def events_blocks(events: DataFrame) -> DataFrame:
    """events as transactions: block_number (the hour, yyyyMMddHH), block_date."""
    return events.select(
        F.date_format("ts", "yyyyMMddHH").cast("bigint").alias("block_number"),
        F.to_date("ts").alias("block_date"),
    )
