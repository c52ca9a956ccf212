"""Running balances, USD valuation and the global detail table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.classify import ordered_like
from flowlake.operators.flows import union_all
from flowlake.operators.pricing import override_price, price_lookup
from flowlake.operators.series import running_sum

VALUE_COLUMNS = ["blockchain", "dt", "protocol", "category", "token_name", "token_address",
                 "balance", "price_usd", "value_usd"]

# Stable-token classifier arms (first match wins, on lower(name)).
STABLE_TOKEN_RULES = [
    ("%usdc%", "USDC"),
    ("%usdt%", "USDT"),
    ("%usde%", "USDe"),
    ("%usds%", "USDS"),
    ("%usd0%", "USD0"),
    ("%dai%", "DAI"),
]
DETAIL_FLOOR = dt.date(2020, 1, 1)


def with_balance(daily: DataFrame) -> DataFrame:
    """balance = Σ daily_net_amount per (blockchain, token) up to the day (RANGE frame)."""
    return running_sum(daily, ["blockchain", "token_address"], "dt", "daily_net_amount", "balance")


def rwa_values(daily: DataFrame, prices: DataFrame, fixed_price_names: list[str],
               aliases: dict[str, str]) -> DataFrame:
    """P-32: balance, price (fixed names → 1, else market price), value."""
    ab = with_balance(daily)
    priced = price_lookup(ab, prices, ["blockchain", "dt"], aliases=aliases, out="_market")
    return priced.select(
        "blockchain", "dt", "protocol", F.lit("rwa").alias("category"), "token_name",
        "token_address", "balance",
        override_price("token_name", fixed_price_names, "_market").alias("price_usd"),
    ).withColumn("value_usd", F.col("price_usd") * F.col("balance")).select(*VALUE_COLUMNS)


def stable_values(daily: DataFrame, index: DataFrame, prices: DataFrame,
                  fixed_price_names: list[str], aliases: dict[str, str],
                  category_mode: str = "reference") -> DataFrame:
    """P-33: price = 1 for fixed names, else the yield index, else the market price.

    ``category_mode='reference'`` labels every row 'rwa' (as the source
    model does); ``'carry'`` keeps the token's own category.
    """
    ab = with_balance(daily)
    idx = index.select("blockchain", "protocol", "dt", "token_address", F.col("index").alias("_index"))
    ab = ab.join(idx, ["blockchain", "protocol", "dt", "token_address"], "left")
    priced = price_lookup(ab, prices, ["blockchain", "dt"], aliases=aliases, out="_market")
    category = F.lit("rwa") if category_mode == "reference" else F.col("category")
    return priced.select(
        "blockchain", "dt", "protocol", category.alias("category"), "token_name",
        "token_address", "balance",
        override_price("token_name", fixed_price_names, "_index", "_market").alias("price_usd"),
    ).withColumn("value_usd", F.col("price_usd") * F.col("balance")).select(*VALUE_COLUMNS)


def united_facts(stables: DataFrame, rwas: DataFrame) -> DataFrame:
    """Both fact tables as one: what the detail table is made from."""
    return union_all([stables.select(*VALUE_COLUMNS), rwas.select(*VALUE_COLUMNS)])


def detail_of(facts: DataFrame, floor: dt.date = DETAIL_FLOOR, rules=None) -> DataFrame:
    """P-34: daily USD total, stable-token class and date floor over the united facts.

    The daily total is a grouped sum (combined map-side, one row per day) joined
    back, so no task gathers a day. ``facts`` is read twice: pass a written table.
    ``amount`` is the balance (the source selects a column its inputs do not have;
    the balance is the only sensible reading).
    """
    both = facts.filter(F.col("dt") >= F.lit(floor))
    totals = both.groupBy("dt").agg(F.sum(F.coalesce(F.col("value_usd"), F.lit(0.0))).alias("value_usd_total"))
    stable_token = F.when(F.col("category") == "rwa", F.lit(None).cast("string")).otherwise(
        ordered_like("token_name", rules or STABLE_TOKEN_RULES, "Others"))
    return both.join(totals, "dt", "left").select(
        "blockchain", "dt", "protocol", "category", "token_name",
        stable_token.alias("stable_token"), "token_address",
        F.col("balance").alias("amount"), "value_usd", "value_usd_total")


def detailed(stables: DataFrame, rwas: DataFrame, floor: dt.date = DETAIL_FLOOR, rules=None) -> DataFrame:
    """The detail table over two written fact tables, as the model graph has them."""
    return detail_of(united_facts(stables, rwas), floor, rules)


def sorted_for_write(df: DataFrame) -> DataFrame:
    """The source's final ORDER BY dt DESC, value_usd DESC (NULLs last).

    Spark's sort range-partitions on the sampled composite key, so one very
    large day is still split over several tasks by value; files come out in
    table order.
    """
    return df.orderBy(F.col("dt").desc(), F.col("value_usd").desc_nulls_last())
