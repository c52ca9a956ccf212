"""Data tests: each returns a DataFrame of failing rows; a test passes when it is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    """TEST-1: rows where ``col`` IS NULL."""
    return df.filter(F.col(col).isNull())


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """TEST-2: key combinations occurring more than once, with their count.

    One aggregate with map-side combine; a hot key is one partial count per
    task, never a collected group.
    """
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def unique(df: DataFrame, col: str) -> DataFrame:
    """TEST-3: values of ``col`` occurring more than once (NULLs ignored)."""
    return unique_combination(df.filter(F.col(col).isNotNull()), [col])


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """TEST-4: distinct non-NULL values outside the accepted list, with counts."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """TEST-5: child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_col).alias(col))
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def custom(df: DataFrame, failing: Column) -> DataFrame:
    """TEST-6: any predicate that marks a row as failing."""
    return df.filter(failing)


def summary(results: dict[str, DataFrame]) -> DataFrame:
    """(test, n_failed) for several tests – one small count job per test."""
    first = None
    for name, fails in results.items():
        row = fails.agg(F.count(F.lit(1)).alias("n_failed")).select(
            F.lit(name).alias("test"), "n_failed")
        first = row if first is None else first.unionByName(row)
    return first


# The data tests declared on the source project's models.
_DAILY_KEYS = ["dt", "blockchain", "token_address"]
_TRANSFER_TESTS = ([("not_null", c) for c in ("dt", "period", "from", "to", "tx_hash", "evt_index")]
                   + [("unique_combination", ("tx_hash", "evt_index"))])
_BLOCK_TESTS = [("unique_combination", ("block_number", "block_date"))]
DECLARED_TESTS = {
    "dbt_yielding_evm_rwas": [("not_null", c) for c in _DAILY_KEYS],
    "dbt_yielding_evm_stablecoins": [("not_null", c) for c in _DAILY_KEYS],
    "dbt_yielding_spl_rwas": [("not_null", c) for c in _DAILY_KEYS],
    "int_yielding_indices": [("not_null", c) for c in _DAILY_KEYS],
    **{f"dbt_tether_{chain}": _TRANSFER_TESTS
       for chain in ("arbitrum", "bnb", "ethereum", "polygon", "solana", "tron")},
    "dbt_template_merge_incremental_model": _BLOCK_TESTS,
    "dbt_template_delete_insert_incremental_model": _BLOCK_TESTS,
    "dbt_template_append_incremental_model": _BLOCK_TESTS,
}


def declared(model: str, df: DataFrame) -> dict[str, DataFrame]:
    """The declared tests of ``model`` as {test name: failing rows}."""
    out = {}
    for kind, arg in DECLARED_TESTS[model]:
        if kind == "not_null":
            out[f"not_null_{model}_{arg}"] = not_null(df, arg)
        else:
            out[f"unique_combination_{model}_{'__'.join(arg)}"] = unique_combination(df, list(arg))
    return out


def null_counts(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """(test, n_failed) of several not-null tests ({test: column}) in one scan."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(t) for t, c in names.items()))
    rows = F.array(*(F.struct(F.lit(t).alias("test"), F.col(t).alias("n_failed")) for t in names))
    return counts.select(F.explode(rows).alias("r")).select("r.test", "r.n_failed")


def run_declared(model: str, df: DataFrame) -> DataFrame:
    """(test, n_failed) for every declared test of ``model``: all not-null tests share a scan."""
    nulls = {f"not_null_{model}_{arg}": arg for kind, arg in DECLARED_TESTS[model] if kind == "not_null"}
    others = {t: fails for t, fails in declared(model, df).items() if t not in nulls}
    parts = [null_counts(df, nulls)] if nulls else []
    if others:
        parts.append(summary(others))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
