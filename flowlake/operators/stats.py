"""Bucketed activity statistics per time period and chain.

Amounts are aggregated once per (period, chain, bucket), with two sums a row, and
the buckets become columns in a second aggregation over at most a handful of rows
per period and chain.  Exact distinct counts come from distinct (period, chain,
role, address) rows: two rows per transfer, combined in each task, and a hot
period is spread by address.  The approximate variant keeps a fixed-size HLL++
sketch per bucket's group instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket edges of the transfer-size statistics. Buckets are
# half-open [lo, hi); the first is "< 100" (negatives included) and the last
# "≥ 1 000 000" is unbounded but labelled 10 000 000.
DEFAULT_EDGES = [100, 1000, 10000, 100000, 1000000]
EXACT = "decimal(37,18)"     # sums and differences of two keep all 18 places


def bucket_conditions(amount: Column, edges: list[float]) -> list[tuple[str, Column]]:
    """[(label, condition)] for the half-open buckets defined by ``edges``."""
    out = [(f"{int(edges[0])}", amount < edges[0])]
    for lo, hi in zip(edges, edges[1:]):
        out.append((f"{int(hi)}", (amount >= lo) & (amount < hi)))
    out.append((f"{int(edges[-1] * 10)}", amount >= edges[-1]))
    return out


def period_start(date_col: str, unit: str) -> Column:
    """date_trunc(unit, dt) kept as DATE (weeks start on Monday)."""
    return F.trunc(F.col(date_col), unit)


WHOLE, PART = "decimal(38,0)", "decimal(38,18)"
LARGE = 1e19      # from here on a double has no fraction


def split_amount(amount: Column) -> tuple[Column, Column]:
    """(whole, fraction) of an amount as exact decimals.

    Below LARGE they are those of its value with 18 places; a larger double is whole
    (up to 1e38).  Sums of the two parts neither depend on row order nor stop at
    1e20, where a sum of DECIMAL(38,18) would.
    """
    exact = F.when(F.abs(amount) < LARGE, amount).cast(EXACT)
    whole = F.floor(exact).cast(WHOLE)
    large = F.when(F.abs(amount) >= LARGE, amount).cast(WHOLE)
    return F.coalesce(whole, large), F.coalesce((exact - whole.cast(EXACT)).cast(PART), F.when(amount.isNotNull(), F.lit(0).cast(PART)))


def joined_amount(whole: Column, part: Column) -> Column:
    """The two sums as one DOUBLE: through one decimal where it fits."""
    small = (F.when(F.abs(whole) < LARGE, whole).cast(EXACT) + F.when(F.abs(whole) < LARGE, part).cast(EXACT))
    return F.coalesce(small.cast("double"), whole.cast("double") + part.cast("double"))


def period_stats(transfers: DataFrame, unit: str, edges: list[float] | None = None,
                 distinct: str = "exact", rsd: float = 0.01, date_col: str = "dt",
                 chain_col: str = "blockchain", amount_col: str = "amount",
                 from_col: str = "from", to_col: str = "to") -> DataFrame:
    """period, blockchain, amount, txs, senders, receivers, tx_<b>…, amt_<b>….

    ``distinct``: 'exact' (COUNT DISTINCT) or 'approx' (HLL++ with ``rsd``).
    Sums are exact and independent of row order, each returned as DOUBLE.
    Empty buckets give count 0 and sum NULL.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError(f"distinct must be 'exact' or 'approx', got {distinct!r}")
    amount = F.col(amount_col)
    buckets = bucket_conditions(amount, edges or DEFAULT_EDGES)
    bucket = F.lit(None).cast("string")
    for label, cond in reversed(buckets):
        bucket = F.when(cond, F.lit(label)).otherwise(bucket)
    keys = ["period", "blockchain"]
    placed = [period_start(date_col, unit).alias("period"), F.col(chain_col).alias("blockchain")]
    whole, part = split_amount(amount)
    by_bucket = (transfers.select(*placed, bucket.alias("_bucket"), whole.alias("_whole"), part.alias("_part"))
                 .groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_whole").alias("_whole"), F.sum("_part").alias("_part")))

    def total(cond: Column | None = None) -> Column:
        w, p = (F.col(c) if cond is None else F.when(cond, F.col(c)) for c in ("_whole", "_part"))
        return joined_amount(F.sum(w), F.sum(p).cast(PART))

    here = {label: F.col("_bucket") == label for label, _ in buckets}
    measures = by_bucket.groupBy(*keys).agg(
        total().alias("amount"), F.sum("_n").alias("txs"),
        *[F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).alias(f"tx_{label}") for label, c in here.items()],
        *[total(c).alias(f"amt_{label}") for label, c in here.items()])
    sides = [("senders", from_col), ("receivers", to_col)]
    if distinct == "approx":
        counts = transfers.select(*placed, *(F.col(c).cast("string").alias(n) for n, c in sides)).groupBy(*keys).agg(
            *(F.approx_count_distinct(n, rsd).alias(n) for n, _ in sides))
    else:
        each = F.array(*(F.struct(F.lit(n).alias("role"), F.col(c).cast("string").alias("address")) for n, c in sides))
        seen = transfers.select(*placed, F.explode(each).alias("s")).select(*keys, "s.role", "s.address").distinct()
        counts = seen.groupBy(*keys).agg(
            *(F.count(F.when(F.col("role") == n, F.col("address"))).alias(n) for n, _ in sides))
    right = counts.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = F.col("period").eqNullSafe(F.col("_period")) & F.col("blockchain").eqNullSafe(F.col("_blockchain"))
    labels = [label for label, _ in buckets]
    return measures.join(right, match).select(
        *keys, "amount", "txs", "senders", "receivers", *[f"tx_{x}" for x in labels], *[f"amt_{x}" for x in labels])
