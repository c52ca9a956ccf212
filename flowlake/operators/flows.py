"""Daily net flows: signed amounts summed per (day, token[, chain]).

Every mint/burn CTE of the reference is one of a few shapes:

* zero-address transfer log (mint = from zero, burn = to zero)
* action-labelled log (action = 'mint' / 'burn')
* paired event tables (deposit/withdraw, mint/redeem): union, burn negated
* lending events scaled by a liquidity index (per-row DOUBLE arithmetic)

Sums over raw integers are exact DECIMAL(38,0); the division by
``10^decimals`` (or a fixed scale) happens once per group, so the result does
not depend on partitioning or row order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.address import ZERO_ADDRESS
from flowlake.functions.amounts import (
    U256, action_sign_value, signed_by_zero_address, touches_zero,
)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (never positional)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _scaled_sum(raw_sum: Column, scale) -> Column:
    """DOUBLE(sum) / 10^d when ``scale`` is decimals (int or column), or / scale when float."""
    if isinstance(scale, float):
        return raw_sum.cast("double") / F.lit(scale)
    d = F.lit(scale) if isinstance(scale, int) else (F.col(scale) if isinstance(scale, str) else scale)
    return raw_sum.cast("double") / F.pow(F.lit(10.0), d)


def net_flow(df: DataFrame, keys: list[str], signed: Column, scale,
             out: str = "amount") -> DataFrame:
    """Σ signed raw value per ``keys``, then one division by the scale.

    ``scale``: a float (fixed divisor like 1e18), an int number of decimals,
    or the name of a decimals column (which is then added to the group keys –
    it is functionally dependent on the token).
    """
    group = list(keys)
    if isinstance(scale, str) and scale not in group:
        group.append(scale)
    agg = df.groupBy(*group).agg(F.sum(signed.cast(U256)).alias("_raw"))
    return agg.select(*keys, _scaled_sum(F.col("_raw"), scale).alias(out))


def zero_address_flow(log: DataFrame, keys: list[str], scale, value: str = "value",
                      from_col: str = "from", to_col: str = "to",
                      zero: str = ZERO_ADDRESS, out: str = "amount") -> DataFrame:
    """Net mint − burn of a transfer log (rows touching the zero address only)."""
    rows = log.filter(touches_zero(from_col, to_col, zero))
    return net_flow(rows, keys, signed_by_zero_address(value, from_col, to_col, zero),
                    scale, out)


def action_flow(log: DataFrame, keys: list[str], scale, value: str = "amount",
                action: str = "action", out: str = "amount") -> DataFrame:
    """Net mint − burn of an action-labelled log; other actions contribute NULL."""
    return net_flow(log, keys, action_sign_value(value, action), scale, out)


def paired_flow(mints: list[DataFrame], burns: list[DataFrame], keys: list[str],
                value: str, scale, out: str = "amount") -> DataFrame:
    """UNION ALL of +mint and −burn rows (several tables each), summed per keys.

    Inputs must already expose ``keys`` and ``value``; variant tables of the
    same event are simply listed together.
    """
    cols = list(dict.fromkeys([*keys, *([scale] if isinstance(scale, str) else [])]))
    plus = [m.select(*cols, F.col(value).cast(U256).alias("_v")) for m in mints]
    minus = [b.select(*cols, (-F.col(value).cast(U256)).alias("_v")) for b in burns]
    return net_flow(union_all(plus + minus), keys, F.col("_v"), scale, out)


def index_scaled_flow(rows: DataFrame, keys: list[str], decimals: str,
                      burn_col: str = "_burn", index: str = "index", value: str = "value",
                      balance_increase: str | None = None,
                      ray: float = 1e27, out: str = "amount") -> DataFrame:
    """Lending supply flow in *scaled* units: ±(value / 10^d) / (index / 1e27).

    ``rows`` holds mint and burn events together, ``burn_col`` tells them
    apart (one pass, one aggregate). With ``balance_increase`` (v3 events)
    the accrued interest is removed: mint uses value − increase, burn
    −(value + increase), both in exact DECIMAL before the DOUBLE division.
    Per-row DOUBLE arithmetic is inherent here (the index division is not
    linear in the sum).
    """
    v = F.col(value).cast(U256)
    burn = F.col(burn_col)
    if balance_increase:
        bi = F.col(balance_increase).cast(U256)
        raw = F.when(burn, -(v + bi)).otherwise(v - bi)
    else:
        raw = F.when(burn, -v).otherwise(v)
    amt = (raw.cast("double") / F.pow(F.lit(10.0), F.col(decimals))) / (
        F.col(index).cast("double") / F.lit(ray))
    return rows.groupBy(*keys).agg(F.sum(amt).alias(out))


def reaggregate(flows: DataFrame, keys: list[str], col: str = "amount") -> DataFrame:
    """Collapse several branches that emit the same key into one row."""
    return flows.groupBy(*keys).agg(F.sum(col).alias(col))
