"""Daily net issuance per token on a dense calendar (yield tokens, RWAs, SPL).

Flow sources are *data*: a list of ``FlowSpec`` rows, each naming its source
tables, shape and scale. ``flow_from_spec`` turns one row into a DataFrame
``(chain, dt, token_address, amount)``; the model unions them, optionally
re-aggregates, and left-joins the result onto the token × day spine.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.functions.address import ZERO_ADDRESS, address_in, raw_name
from flowlake.functions.amounts import action_sign_value, signed_by_zero_address
from flowlake.operators.flows import index_scaled_flow, net_flow, union_all
from flowlake.operators.spine import calendar_spine, dedup_tokens, densify

YIELD_TOKEN_KEYS = ["chain", "category", "protocol", "token_address", "token_name",
                    "underlying_token_address", "underlying_token_name"]
RWA_TOKEN_KEYS = ["blockchain", "protocol", "token_address", "token_name"]
FLOW_COLUMNS = ["chain", "dt", "token_address", "amount"]


@dataclass(frozen=True)
class FlowSpec:
    """One mint/burn source of a daily-flow model.

    kind:
      * ``zero_address`` – transfer log, mint = from zero, burn = to zero
      * ``paired`` – ``sources`` are mint tables, ``burn_sources`` burn tables
      * ``lending`` – mint/burn tables scaled by a liquidity index
      * ``lending_interest`` – same, minus the accrued ``balanceIncrease``
      * ``action`` – log with an ``action`` column (mint / burn / other)
    join: None (no token join), 'address' (address only),
      'address_fixed_chain' (address and token chain = ``chain``) or
      'chain_address' (address and token chain = the source's chain column);
      the token dimension is filtered to ``protocol`` when one is given.
    chain: literal chain of the output (None = the source's ``chain`` column,
      or the token's chain when joined on chain).
    scale: fixed divisor (e.g. 1e18); None = 10^token_decimals of the token.
    since_start: keep only events on/after the token's start_date.
    """
    name: str
    kind: str
    sources: tuple[str, ...]
    burn_sources: tuple[str, ...] = ()
    protocol: str | None = None
    join: str | None = None
    chain: str | None = None
    scale: float | None = None
    value_col: str = "value"
    burn_value_col: str | None = None
    from_col: str = "from"
    to_col: str = "to"
    date_col: str = "evt_block_date"
    date_from_time: str | None = None
    address_col: str = "contract_address"
    since_start: bool = False
    enabled: bool = True


def _prepare(df: DataFrame, spec: FlowSpec, ctx: RunContext | None,
             value_col: str) -> DataFrame:
    """Rename to (dt, token_address, [chain], value…) and apply the lookback bound."""
    dt_expr = F.to_date(F.col(spec.date_from_time)) if spec.date_from_time else F.col(spec.date_col)
    cols = [dt_expr.alias("dt"), F.col(spec.address_col).alias("token_address")]
    if spec.chain is not None:
        cols.append(F.lit(spec.chain).alias("chain"))
    elif "chain" in df.columns:
        cols.append(F.col("chain"))
    keep = {value_col, spec.from_col, spec.to_col, "index", "balanceIncrease", "action",
            raw_name(spec.from_col), raw_name(spec.to_col)}
    cols += [F.col(c) for c in df.columns if c in keep and c not in ("chain",)]
    if ctx is not None and ctx.incremental:
        # A literal bound on a physical column of the source, so it reaches the
        # Parquet scan: the date column when there is one, else the time column.
        if spec.date_col in df.columns:
            df = df.filter(F.col(spec.date_col) >= F.lit(ctx.window_start))
        else:
            start = _dt.datetime.combine(ctx.window_start, _dt.time())
            df = df.filter(F.col(spec.date_from_time) >= F.lit(start))
    return df.select(*cols)


def _join_tokens(df: DataFrame, tokens: DataFrame | None, spec: FlowSpec) -> DataFrame:
    if spec.join is None or tokens is None:
        return df
    chain_col = "chain" if "chain" in tokens.columns else "blockchain"
    if spec.protocol is not None:
        tokens = tokens.filter(F.col("protocol") == spec.protocol)
    tk = tokens.select(
        F.col("token_address").alias("_tk_address"), F.col(chain_col).alias("_tk_chain"),
        "token_decimals", "start_date")
    cond = F.col("token_address") == F.col("_tk_address")
    if spec.join == "chain_address":
        if "chain" not in df.columns:
            raise ValueError(f"flow {spec.name!r} joins on chain, but its source has no chain column")
        cond = cond & (F.col("chain") == F.col("_tk_chain"))
    elif spec.join == "address_fixed_chain":
        cond = cond & (F.col("_tk_chain") == F.lit(spec.chain))
    if spec.since_start:
        cond = cond & (F.col("dt") >= F.col("start_date"))
    joined = df.join(tk, cond, "inner")
    if "chain" not in df.columns:
        joined = joined.withColumn("chain", F.col("_tk_chain"))
    return joined.drop("_tk_address", "_tk_chain", "start_date")


def _signed_rows(spec: FlowSpec, read: Callable[[str], DataFrame],
                 ctx: RunContext | None) -> DataFrame:
    """All source rows of a spec as (dt, token_address, [chain], _v = signed raw amount)."""
    if spec.kind == "paired":
        burn_value = spec.burn_value_col or spec.value_col
        parts = [(s, spec.value_col, 1) for s in spec.sources]
        parts += [(s, burn_value, -1) for s in spec.burn_sources]
        out = []
        for src, value, sign in parts:
            df = _prepare(read(src), spec, ctx, value)
            v = F.col(value).cast("decimal(38,0)")
            out.append(df.select(*[c for c in ("dt", "token_address", "chain") if c in df.columns],
                                 (v if sign > 0 else -v).alias("_v")))
        return union_all(out)
    parts = [_prepare(read(s), spec, ctx, spec.value_col) for s in spec.sources]
    if spec.kind == "zero_address":
        # on the stored columns, source by source: the filter reaches each scan
        parts = [p.filter(address_in(p, spec.from_col, [ZERO_ADDRESS]) | address_in(p, spec.to_col, [ZERO_ADDRESS]))
                 .drop(raw_name(spec.from_col), raw_name(spec.to_col)) for p in parts]
    rows = union_all(parts)
    if spec.kind == "zero_address":
        signed = signed_by_zero_address(spec.value_col, spec.from_col, spec.to_col)
    else:
        signed = action_sign_value(spec.value_col, "action")
    return rows.select(*[c for c in ("dt", "token_address", "chain") if c in rows.columns],
                       signed.cast("decimal(38,0)").alias("_v"))


def flow_from_spec(spec: FlowSpec, read: Callable[[str], DataFrame],
                   tokens: DataFrame | None, ctx: RunContext | None = None) -> DataFrame:
    """One FlowSpec → (chain, dt, token_address, amount).

    Additive flows are summed to one row per (chain, day, token) *before* the
    token join: the join, its start-date residual and the per-token decimals
    then touch daily aggregates instead of raw events, so a hot token is
    absorbed by the map-side partial sum and never becomes a skewed join
    partition. Exact DECIMAL sums make this identical to joining row by row.
    Lending flows divide each row by its own index, so they join first.
    """
    keys = ["chain", "dt", "token_address"]
    scale = spec.scale if spec.scale is not None else "token_decimals"
    if spec.kind in ("zero_address", "action", "paired"):
        rows = _signed_rows(spec, read, ctx)
        if spec.join is not None and tokens is not None:
            group = [c for c in ("chain", "dt", "token_address") if c in rows.columns]
            rows = _join_tokens(rows.groupBy(*group).agg(F.sum("_v").alias("_v")), tokens, spec)
        return net_flow(rows, keys, F.col("_v"), scale)
    if spec.kind in ("lending", "lending_interest"):
        mint = _prepare(read(spec.sources[0]), spec, ctx, spec.value_col)
        burn = _prepare(read(spec.burn_sources[0]), spec, ctx, spec.value_col)
        rows = _join_tokens(mint.withColumn("_burn", F.lit(False)).unionByName(
            burn.withColumn("_burn", F.lit(True))), tokens, spec)
        return index_scaled_flow(
            rows, keys, decimals="token_decimals", burn_col="_burn", value=spec.value_col,
            balance_increase="balanceIncrease" if spec.kind == "lending_interest" else None)
    raise ValueError(f"unknown flow kind {spec.kind!r}")


def all_flows(specs: list[FlowSpec], read: Callable[[str], DataFrame],
              tokens: DataFrame | None, ctx: RunContext | None = None,
              reaggregate: bool = True) -> DataFrame:
    """UNION ALL of the enabled flows; ``reaggregate`` collapses branches sharing a key."""
    flows = union_all([flow_from_spec(s, read, tokens, ctx).select(*FLOW_COLUMNS)
                       for s in specs if s.enabled])
    if reaggregate:
        flows = flows.groupBy("chain", "dt", "token_address").agg(F.sum("amount").alias("amount"))
    return flows


def yield_spine(tokens: DataFrame, ctx: RunContext) -> DataFrame:
    """P-1: 7-column dedup of the token seed (min start_date), one row per day."""
    dedup = dedup_tokens(tokens, YIELD_TOKEN_KEYS)
    return calendar_spine(dedup, ctx.as_of, YIELD_TOKEN_KEYS,
                          window_start=ctx.window_start if ctx.incremental else None)


def yield_daily(spine: DataFrame, flows: DataFrame, ctx: RunContext) -> DataFrame:
    """P-9: spine ⟕ flows on (dt, chain, token), 0 where no flow."""
    out = densify(spine, flows, on=["dt", "chain", "token_address"], value="amount",
                  out="daily_net_amount")
    out = out.select("dt", F.col("chain").alias("blockchain"), "category", "protocol",
                     "token_address", "token_name", "underlying_token_address",
                     "underlying_token_name", "daily_net_amount")
    return out.filter(F.col("dt") >= F.lit(ctx.window_start)) if ctx.incremental else out


def rwa_spine(tokens: DataFrame, ctx: RunContext) -> DataFrame:
    """P-10 / P-23 spine: every seed row (no dedup), one row per day."""
    return calendar_spine(tokens, ctx.as_of, RWA_TOKEN_KEYS,
                          window_start=ctx.window_start if ctx.incremental else None)


def rwa_daily(spine: DataFrame, flows: DataFrame, ctx: RunContext) -> DataFrame:
    """P-22 / P-23: blockchain, dt, protocol, token_name, token_address, daily_net_amount."""
    f = flows.withColumnRenamed("chain", "blockchain")
    out = densify(spine, f, on=["dt", "token_address", "blockchain"], value="amount",
                  out="daily_net_amount")
    out = out.select("blockchain", "dt", "protocol", "token_name", "token_address",
                     "daily_net_amount")
    return out.filter(F.col("dt") >= F.lit(ctx.window_start)) if ctx.incremental else out

