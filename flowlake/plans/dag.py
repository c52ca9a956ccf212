"""Run the reference's model graph with its materializations.

Order follows the ``ref()`` edges: daily flows → indices → fact tables →
detail table, and per-chain transfers → weekly / monthly stats. Every model
is written to ``out_dir/<model>`` with the strategy, unique key and
partitioning of the source model; downstream models read the written tables,
which cuts the lineage at each hop (as the warehouse does). A run that failed is
started again from the first model; the incremental strategies make that repeat
itself without changing what was already written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flowlake.context import RunContext
from flowlake.plans import defaults as D
from flowlake.plans import models as M
from flowlake.plans.balances import sorted_for_write
from flowlake.sinks import materialize, write_table
from flowlake.sources.catalog import Catalog
from flowlake.sources.seeds import Seed


@dataclass(frozen=True)
class ModelConfig:
    """``on_table_exists`` is how a full rebuild replaces the table."""
    strategy: str
    unique_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    on_table_exists: str = "rename"


# Materialization of each model in the source project.
MODELS = {
    "dbt_yielding_evm_stablecoins": ModelConfig("delete+insert", ("dt", "blockchain", "token_address"),
                                                ("dt", "blockchain"), on_table_exists="drop"),
    "dbt_yielding_evm_rwas": ModelConfig("delete+insert", ("dt", "blockchain", "token_address"),
                                         ("dt", "blockchain")),
    "dbt_yielding_spl_rwas": ModelConfig("delete+insert", ("dt", "token_address"), ("dt",)),
    "int_yielding_indices": ModelConfig("table", on_table_exists="drop"),
    "fct_yielding_evm_stablecoins": ModelConfig("table", on_table_exists="drop"),
    "fct_yielding_rwas": ModelConfig("table", on_table_exists="drop"),
    "fct_yielding_detailed": ModelConfig("table", on_table_exists="drop"),
    "dbt_tether": ModelConfig("delete+insert", ("dt", "tx_hash", "evt_index"), ("dt",)),
    "fct_tether_weekly_stats": ModelConfig("delete+insert", ("period", "blockchain")),
    "fct_tether_monthly_stats": ModelConfig("delete+insert", ("period", "blockchain")),
}


def _run(spark: SparkSession, name: str, build, out_dir: str, ctx: RunContext,
         full_refresh: bool, table: str | None = None) -> DataFrame:
    cfg = MODELS[name]
    return materialize(spark, build, f"{out_dir}/{table or name}", ctx, cfg.strategy,
                       list(cfg.unique_key) or None, list(cfg.partition_by) or None,
                       full_refresh=full_refresh, on_table_exists=cfg.on_table_exists)


def run_yield_models(spark: SparkSession, catalog: Catalog, yield_tokens: Seed,
                     rwa_tokens: Seed, spl_tokens: Seed | None, ctx: RunContext, out_dir: str,
                     full_refresh: bool = False) -> dict[str, DataFrame]:
    """Daily flows → indices → fact tables → detail table; returns the written tables."""
    out = {}
    out["dbt_yielding_evm_stablecoins"] = _run(
        spark, "dbt_yielding_evm_stablecoins",
        lambda c: M.evm_stables_daily(catalog, yield_tokens, c), out_dir, ctx, full_refresh)
    out["dbt_yielding_evm_rwas"] = _run(
        spark, "dbt_yielding_evm_rwas",
        lambda c: M.evm_rwas_daily(catalog, rwa_tokens, c), out_dir, ctx, full_refresh)
    if spl_tokens is not None:
        out["dbt_yielding_spl_rwas"] = _run(
            spark, "dbt_yielding_spl_rwas",
            lambda c: M.spl_rwas_daily(catalog, spl_tokens, c), out_dir, ctx, full_refresh)
    out["int_yielding_indices"] = _run(
        spark, "int_yielding_indices",
        lambda c: M.yield_indices(catalog, yield_tokens, c), out_dir, ctx, True)
    prices = catalog.read(D.TOKEN_PRICES)
    stables = sorted_for_write(M.fct_stables(out["dbt_yielding_evm_stablecoins"],
                                             out["int_yielding_indices"], prices))
    out["fct_yielding_evm_stablecoins"] = write_table(spark, stables, f"{out_dir}/fct_yielding_evm_stablecoins",
        on_table_exists=MODELS["fct_yielding_evm_stablecoins"].on_table_exists)
    rwas = sorted_for_write(M.fct_rwas(out["dbt_yielding_evm_rwas"], prices))
    out["fct_yielding_rwas"] = write_table(spark, rwas, f"{out_dir}/fct_yielding_rwas",
        on_table_exists=MODELS["fct_yielding_rwas"].on_table_exists)
    detail = sorted_for_write(M.fct_detailed(out["fct_yielding_evm_stablecoins"],
                                             out["fct_yielding_rwas"]))
    out["fct_yielding_detailed"] = write_table(spark, detail, f"{out_dir}/fct_yielding_detailed",
        on_table_exists=MODELS["fct_yielding_detailed"].on_table_exists)
    return out


def run_tether_models(spark: SparkSession, catalog: Catalog, ctx: RunContext, out_dir: str,
                      sources: list[str] | None = None,
                      full_refresh: bool = False) -> dict[str, DataFrame]:
    """Per-chain normalised transfers, then weekly and monthly statistics."""
    out = {}
    chains = []
    for src in sources or list(D.TETHER_SOURCES):
        chain = next(iter(D.TETHER_SOURCES[src].chains.values()))[0]
        out[f"dbt_tether_{chain}"] = _run(
            spark, "dbt_tether", lambda c, s=src: M.tether_transfers(catalog, s, c), out_dir, ctx,
            full_refresh, table=f"dbt_tether_{chain}")
        chains.append(out[f"dbt_tether_{chain}"])
    for unit, name in (("week", "fct_tether_weekly_stats"), ("month", "fct_tether_monthly_stats")):
        out[name] = _run(spark, name, lambda c, u=unit: M.tether_stats(chains, u, c), out_dir, ctx,
                         full_refresh)
    return out


def run_model_tests(outputs: dict[str, DataFrame]) -> DataFrame:
    """Run the declared data tests of every written model: (test, n_failed)."""
    from flowlake import checks

    tests = {}
    for name, df in outputs.items():
        if name in checks.DECLARED_TESTS:
            tests.update(checks.declared(name, df))
    return checks.summary(tests)
