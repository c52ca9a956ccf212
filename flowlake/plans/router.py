"""All flows of a deployment in one pass over each physical table.

``flow_from_spec`` reads its sources itself, so a model of eleven flows scans a
shared table eleven times.  Here the flow list is grouped by physical table:

1. *Route*: each table is scanned once.  Every row is tagged with the flows it
   feeds (a row may feed several), with its signed amount in each.
2. *Aggregate*: one sum per (flow, chain, day, token) over the rows of all tables.
3. *Tokens*: one join with the token rows of all flows, keyed by (flow, token);
   each flow keeps its own join rule (address, chain, start date) as a residual.
4. *Scale*: the fixed scale of the flow or the token's decimals.

A ``LogicalSource`` says which rows of which table a source name stands for.
Filters of all flows of a table are OR-ed on its stored columns before the rows
are tagged, so they reach the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.context import RunContext
from flowlake.functions.address import ZERO_ADDRESS
from flowlake.functions.amounts import U256, action_sign_value, signed_by_zero_address
from flowlake.operators.flows import union_all
from flowlake.plans.daily_flows import FLOW_COLUMNS, FlowSpec

RAY = 1e27


@dataclass(frozen=True)
class LogicalSource:
    """Rows of a physical table that a source name stands for.

    ``columns`` maps the names the flow specs use to expressions over the table
    (a name that is not listed is a column of that name); ``where`` picks the rows.
    """
    table: str
    columns: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None

    def get(self, name: str) -> Column:
        return self.columns.get(name, F.col(name))


@dataclass(frozen=True)
class _Feed:
    spec: FlowSpec
    source: LogicalSource
    sign: int | None        # None: the row itself says whether it mints or burns


def _feeds(spec: FlowSpec, sources: Mapping[str, LogicalSource]) -> list[_Feed]:
    if spec.kind in ("zero_address", "action"):
        return [_Feed(spec, sources[s], None) for s in spec.sources]
    if spec.kind in ("paired", "lending", "lending_interest"):
        return [_Feed(spec, sources[s], 1) for s in spec.sources] + [_Feed(spec, sources[s], -1) for s in spec.burn_sources]
    raise ValueError(f"unknown flow kind {spec.kind!r}")


def _condition(feed: _Feed, ctx: RunContext | None) -> Column:
    spec, source = feed.spec, feed.source
    # NULL counts as false: in the filter, and as a tag that is NULL
    out = F.lit(True) if source.where is None else source.where
    if spec.kind == "zero_address":
        out = out & ((source.get(spec.from_col) == ZERO_ADDRESS) | (source.get(spec.to_col) == ZERO_ADDRESS))
    if ctx is not None and ctx.incremental:
        if spec.date_from_time:
            start = dt.datetime.combine(ctx.window_start, dt.time())
            out = out & (source.get(spec.date_from_time) >= F.lit(start))
        else:
            out = out & (source.get(spec.date_col) >= F.lit(ctx.window_start))
    return out


def _amounts(feed: _Feed) -> tuple[Column, Column]:
    """(exact signed raw amount, index-scaled amount); the one that does not apply is NULL."""
    spec, source = feed.spec, feed.source
    name = spec.burn_value_col if feed.sign == -1 and spec.burn_value_col else spec.value_col
    value = source.get(name).cast(U256)
    if spec.kind == "zero_address":
        return signed_by_zero_address(value, source.get(spec.from_col), source.get(spec.to_col)).cast(U256), F.lit(None)
    if spec.kind == "action":
        return action_sign_value(value, source.get("action")).cast(U256), F.lit(None)
    signed = value if feed.sign == 1 else -value
    if spec.kind == "paired":
        return signed.cast(U256), F.lit(None)
    if spec.kind == "lending_interest":
        signed = signed - source.get("balanceIncrease").cast(U256)     # off a mint, and on top of a burn
    return F.lit(None), signed.cast("double") / (source.get("index").cast("double") / F.lit(RAY))


def _tag(feed: _Feed, ctx: RunContext | None) -> Column:
    spec, source = feed.spec, feed.source
    if spec.chain is not None:
        chain = F.lit(spec.chain)
    elif spec.join == "address":
        chain = F.lit(None).cast("string")                             # the token's
    else:
        chain = source.get("chain")
    day = F.to_date(source.get(spec.date_from_time)) if spec.date_from_time else source.get(spec.date_col)
    exact, scaled = _amounts(feed)
    return F.when(_condition(feed, ctx), F.struct(
        F.lit(spec.name).alias("flow"), chain.alias("chain"), day.cast("date").alias("dt"),
        source.get(spec.address_col).alias("token_address"), exact.cast(U256).alias("exact"), scaled.cast("double").alias("scaled")))


def routed_rows(specs: list[FlowSpec], sources: Mapping[str, LogicalSource], read: Callable[[str], DataFrame],
                ctx: RunContext | None = None) -> DataFrame:
    """(flow, chain, dt, token_address, exact, scaled): the tagged rows of all tables, each scanned once."""
    by_table: dict[str, list[_Feed]] = {}
    for spec in specs:
        for feed in _feeds(spec, sources):
            by_table.setdefault(feed.source.table, []).append(feed)
    parts = []
    for table, feeds in by_table.items():
        wanted = reduce(lambda a, b: a | b, (_condition(f, ctx) for f in feeds))
        # a flow that a row does not feed gives a NULL struct, hence a row of NULLs
        tagged = read(table).filter(wanted).select(F.inline(F.array(*(_tag(f, ctx) for f in feeds))))
        parts.append(tagged.filter(F.col("flow").isNotNull()))
    return union_all(parts)


def _flow_tokens(specs: list[FlowSpec], tokens: DataFrame) -> DataFrame | None:
    """Token rows of every flow that joins: (flow, address, chain it must equal, chain, decimals, first day)."""
    chain = "chain" if "chain" in tokens.columns else "blockchain"
    parts = []
    for spec in specs:
        if spec.join is None:
            continue
        own = tokens if spec.protocol is None else tokens.filter(F.col("protocol") == spec.protocol)
        if spec.join == "address_fixed_chain":
            own = own.filter(F.col(chain) == spec.chain)
        must = F.col(chain) if spec.join == "chain_address" else F.lit(None).cast("string")
        first = F.col("start_date") if spec.since_start else F.lit(None).cast("date")
        parts.append(own.select(F.lit(spec.name).alias("_flow"), F.col("token_address").alias("_address"), must.alias("_must"),
                                F.col(chain).alias("_chain"), F.col("token_decimals").alias("_decimals"), first.alias("_first")))
    return union_all(parts) if parts else None


def routed_flows(specs: list[FlowSpec], sources: Mapping[str, LogicalSource], read: Callable[[str], DataFrame],
                 tokens: DataFrame, ctx: RunContext | None = None) -> DataFrame:
    """(flow, chain, dt, token_address, amount) of the enabled flows."""
    specs = [s for s in specs if s.enabled]
    names = [s.name for s in specs]
    if len(set(names)) != len(names):
        raise ValueError("flow names must differ")
    keys = ["flow", "chain", "dt", "token_address"]
    sums = routed_rows(specs, sources, read, ctx).groupBy(*keys).agg(F.sum("exact").alias("exact"), F.sum("scaled").alias("scaled"))
    joining = _flow_tokens(specs, tokens)
    if joining is not None:
        match = ((F.col("flow") == F.col("_flow")) & (F.col("token_address") == F.col("_address"))
                 & (F.col("_must").isNull() | (F.col("chain") == F.col("_must")))
                 & (F.col("_first").isNull() | (F.col("dt") >= F.col("_first"))))
        free = [s.name for s in specs if s.join is None]
        sums = sums.join(joining, match, "left").filter(F.col("_flow").isNotNull() | F.col("flow").isin(free))
        sums = sums.withColumn("chain", F.coalesce("chain", "_chain"))
        decimals = F.pow(F.lit(10.0), F.col("_decimals"))
    else:
        decimals = F.lit(None).cast("double")
    scale = decimals
    for spec in specs:
        if spec.scale is not None:
            scale = F.when(F.col("flow") == spec.name, F.lit(spec.scale)).otherwise(scale)
    amount = F.coalesce(F.col("exact").cast("double"), F.col("scaled")) / scale
    return sums.select(*keys, amount.alias("amount")).groupBy(*keys).agg(F.sum("amount").alias("amount"))


def all_routed(specs: list[FlowSpec], sources: Mapping[str, LogicalSource], read: Callable[[str], DataFrame],
               tokens: DataFrame, ctx: RunContext | None = None) -> DataFrame:
    """The flows of a model without their names: what ``all_flows`` gives."""
    flows = routed_flows(specs, sources, read, tokens, ctx)
    return flows.groupBy("chain", "dt", "token_address").agg(F.sum("amount").alias("amount")).select(*FLOW_COLUMNS)


def flow_report(specs: list[FlowSpec], flows: DataFrame) -> DataFrame:
    """One row per flow of the list, disabled ones too: rows and total (0 where a flow gives nothing)."""
    listed = flows.sparkSession.createDataFrame([(s.name, s.enabled) for s in specs], "flow string, enabled boolean")
    totals = flows.groupBy("flow").agg(F.count("*").alias("n_rows"), F.sum("amount").alias("total"))
    return listed.join(totals, "flow", "left").select(
        "flow", "enabled", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("total", F.lit(0.0)).alias("total"))
