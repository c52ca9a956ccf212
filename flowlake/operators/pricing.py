"""Price lookup with substitute tokens and fixed-price overrides.

The reference joins prices with
``ON chain AND day AND ((tok = SUB AND p.tok = SRC) OR tok = p.tok)``. With
only (chain, day) as hash keys, every balance row is compared with every
price row of its day – quadratic in the number of tokens. Here the price side
is expanded instead: a price row of token SRC is emitted once more under the
lookup key SUB, and the join is a plain equi join on (chain, day, token).
The two forms return exactly the same rows (including both rows when SUB also
has its own price), because SUB ≠ SRC makes the two match sets disjoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.address import canonical_token


def expand_price_keys(prices: DataFrame, token: str, aliases: dict[str, str],
                      out: str = "_lookup") -> DataFrame:
    """Add ``out`` = each key a price row answers for (its own token + substitutes)."""
    if not aliases:
        return prices.withColumn(out, F.col(token))
    by_source: dict[str, list[str]] = {}
    for sub, src in aliases.items():
        if sub == src:
            raise ValueError("a substitute must differ from its source token")
        by_source.setdefault(src, []).append(sub)
    expr: Column | None = None
    for src, subs in by_source.items():
        arr = F.array(F.col(token), *[F.lit(s) for s in subs])
        cond = F.col(token) == F.lit(src)
        expr = F.when(cond, arr) if expr is None else expr.when(cond, arr)
    return prices.withColumn(out, F.explode(expr.otherwise(F.array(F.col(token)))))


def price_lookup(balances: DataFrame, prices: DataFrame, keys: list[str],
                 token: str = "token_address", price: str = "price_usd",
                 aliases: dict[str, str] | None = None,
                 out: str = "price_usd") -> DataFrame:
    """balances ⟕ prices on keys + token (with substitutes); adds column ``out``.

    Price tokens may be varbinary or hex text in any case; balances hold
    canonical text.
    """
    canonical = prices.select(*keys, canonical_token(prices, token).alias(token), price)
    p = expand_price_keys(canonical, token, aliases or {})
    p = p.select(*keys, F.col("_lookup").alias(token), F.col(price).alias("_price"))
    return balances.join(p, on=[*keys, token], how="left").withColumnRenamed("_price", out)


def override_price(name_col: str, fixed_names: list[str], *fallbacks: str,
                   fixed_price: float = 1.0) -> Column:
    """CASE WHEN name IN (fixed) THEN 1 WHEN f1 IS NOT NULL THEN f1 … ELSE last END."""
    expr = F.when(F.col(name_col).isin(*fixed_names), F.lit(fixed_price)) if fixed_names else None
    *firsts, last = fallbacks
    for f in firsts:
        cond = F.col(f).isNotNull()
        expr = F.when(cond, F.col(f)) if expr is None else expr.when(cond, F.col(f))
    if expr is None:
        return F.col(last).cast("double")
    return expr.otherwise(F.col(last)).cast("double")
