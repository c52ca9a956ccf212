"""Running balances, prices, fact and detail tables (P-32…P-34)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlake.plans.balances import detail_of, rwa_values, STABLE_TOKEN_RULES, stable_values, united_facts
from flowlake.session import workspace_dir
from flowlake.sinks import write_table
from flowlake.sources import testdata as td, testdata_sql as tsql

from flowlake.queries.registry import register
from flowlake.queries.flows import densified_sql, RWA_DAILY_SQL, _rwa_daily, _yield_daily
from flowlake.queries.indices import FIXED_PRICE_NAMES, INDEX_UNION_SQL, PRICE_ALIASES, _index_table


# ------------------------------------------------------------ valuation

def _in_list(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


# each price answers for its own token, and one more time for the token it stands in for
QUOTES_SQL = f"""SELECT blockchain, dt, token_address, price_usd AS quote FROM ({tsql.EVENTS_PRICES})
""" + "".join(f"""UNION ALL SELECT blockchain, dt, '{sub}', price_usd FROM ({tsql.EVENTS_PRICES}) WHERE token_address = '{src}'
""" for sub, src in PRICE_ALIASES.items())


def _r(expr: str, rounded: bool) -> str:
    return f"round({expr}, 6)" if rounded else expr


def _valued_sql(daily_sql: str, category: str, rounded: bool, index_sql: str | None = None) -> str:
    """Balance so far, the first known of fixed price, yield index and quote, and their product."""
    known = [f"CASE WHEN holding.token_name IN ({_in_list(FIXED_PRICE_NAMES)}) THEN 1.0 END"]
    lookups = ""
    if index_sql:
        known.append('yield_index."index"')
        lookups += f"LEFT JOIN ({index_sql}) yield_index USING (dt, blockchain, protocol, token_address)\n"
    known.append("market.quote")
    lookups += f"LEFT JOIN ({QUOTES_SQL}) market USING (dt, blockchain, token_address)"
    return f"""WITH holding AS (
  SELECT * EXCLUDE (daily_net_amount), sum(daily_net_amount) OVER day_by_day AS balance FROM ({daily_sql})
  WINDOW day_by_day AS (PARTITION BY blockchain, token_address ORDER BY dt)),
priced AS (SELECT holding.*, coalesce({', '.join(known)}) AS price_usd FROM holding
{lookups})
SELECT blockchain, dt, protocol, {category} AS category, token_name, token_address,
  {_r('balance', rounded)} AS balance, price_usd, {_r('price_usd * balance', rounded)} AS value_usd FROM priced"""


def _rwa_values_sql(rounded: bool) -> str:
    return _valued_sql(RWA_DAILY_SQL, "'rwa'", rounded)


def _densified_sql(rounded: bool) -> str:
    return densified_sql(rounded)


def _stable_values_sql(rounded: bool, category: str = "category") -> str:
    return _valued_sql(_densified_sql(False), category, rounded, INDEX_UNION_SQL)


def _stable_class_sql() -> str:
    """First matching name pattern, for tokens that are not real-world assets."""
    patterns = ", ".join(f"('{pattern}', '{label}', {i})" for i, (pattern, label) in enumerate(STABLE_TOKEN_RULES))
    return f"""CASE WHEN category <> 'rwa' OR category IS NULL THEN coalesce((
    SELECT arg_min(rule.label, rule.place) FROM (VALUES {patterns}) rule(pattern, label, place)
    WHERE lower(token_name) LIKE rule.pattern), 'Others') END"""


def _detailed_sql(category: str) -> str:
    """``category``: the stable facts' category expression."""
    return f"""WITH fact AS (
  FROM ({_rwa_values_sql(False)}) UNION ALL FROM ({_stable_values_sql(False, category)})),
day_total AS (SELECT dt, sum(value_usd) AS total FROM fact GROUP BY dt)
SELECT blockchain, dt, protocol, category, token_name, {_stable_class_sql()} AS stable_token, token_address,
  round(balance, 6) AS amount, round(value_usd, 6) AS value_usd, round(coalesce(total, 0), 6) AS value_usd_total
FROM fact JOIN day_total USING (dt) WHERE dt >= DATE '2020-01-01'"""


ROUND_VALUE_COLS = ["balance", "value_usd"]


def _round(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _rwa_values(spark, d):
    ev = td.read(spark, d, "events")
    return rwa_values(_rwa_daily(spark, d), td.events_daily_prices(ev), FIXED_PRICE_NAMES,
                      PRICE_ALIASES)


def _stable_values(spark, d, category_mode="carry"):
    ev = td.read(spark, d, "events")
    return stable_values(_yield_daily(spark, d), _index_table(spark, d), td.events_daily_prices(ev),
                         FIXED_PRICE_NAMES, PRICE_ALIASES, category_mode=category_mode)


def _detailed(spark, d, category_mode: str):
    """The detail table over the united facts, written once by one job."""
    facts = united_facts(_stable_values(spark, d, category_mode), _rwa_values(spark, d))
    stored = write_table(spark, facts, workspace_dir(spark, "facts"))
    return _round(detail_of(stored), ["amount", "value_usd", "value_usd_total"])


@register("running_balance", f"""SELECT blockchain, dt, category, protocol, token_name, token_address,
  round(daily_net_amount, 6) AS daily_net_amount,
  round(sum(daily_net_amount) OVER (PARTITION BY blockchain, token_address ORDER BY dt), 6) AS balance
FROM ({_densified_sql(False)})""")
def q_running_balance(spark, d):
    """WIN-1: running SUM over (blockchain, token) ordered by day, RANGE frame."""
    from flowlake.plans.balances import with_balance
    out = with_balance(_yield_daily(spark, d)).select(
        "blockchain", "dt", "category", "protocol", "token_name", "token_address",
        "daily_net_amount", "balance")
    return _round(out, ["daily_net_amount", "balance"])


@register("price_lookup_or_join", _rwa_values_sql(True))
def q_price_lookup_or_join(spark, d):
    """P-32: RWA balances priced with a substitute-token price join and fixed-price names."""
    return _round(_rwa_values(spark, d), ROUND_VALUE_COLS)


@register("price_override_value", _stable_values_sql(True))
def q_price_override_value(spark, d):
    """P-33: fixed price → yield index → market price, value = price × balance."""
    return _round(_stable_values(spark, d), ROUND_VALUE_COLS)


@register("price_override_value_default", _stable_values_sql(True, "'rwa'"))
def q_price_override_value_default(spark, d):
    """P-33 as the source has it: every row is labelled 'rwa'."""
    return _round(_stable_values(spark, d, "reference"), ROUND_VALUE_COLS)


@register("detailed_with_totals", _detailed_sql("category"))
def q_detailed_with_totals(spark, d):
    """P-34: union of both fact tables, daily USD total, stable-token class, date floor."""
    return _detailed(spark, d, "carry")


@register("detailed_default", _detailed_sql("'rwa'"))
def q_detailed_default(spark, d):
    """P-34 over the default category: no row has a stable-token class."""
    return _detailed(spark, d, "reference")
