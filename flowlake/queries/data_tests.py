"""Data tests, declared model tests, keys and approximate-distinct accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake import checks
from flowlake.functions.keys import surrogate_key
from flowlake.plans.transfers import transfer_stats
from flowlake.sources import testdata as td

from flowlake.queries.registry import register
from flowlake.queries.transfers import NORM_LINEITEM_SQL, _normalised, _stats_sql
from flowlake.queries.valuation import ROUND_VALUE_COLS, _round, _rwa_values, _rwa_values_sql


# ------------------------------------------------------------ data tests

@register("check_not_null", f"""SELECT * FROM ({_rwa_values_sql(True)}) WHERE price_usd IS NULL""")
def q_check_not_null(spark, d):
    """TEST-1: priced RWA rows without a price."""
    return checks.not_null(_round(_rwa_values(spark, d), ROUND_VALUE_COLS), "price_usd")


@register("check_unique_combination", """SELECT l_orderkey, l_linenumber, count(1) AS n_records
FROM lineitem GROUP BY 1, 2 HAVING count(1) > 1""")
def q_check_unique_combination(spark, d):
    """TEST-2: (l_orderkey, l_linenumber) is not unique in the test data."""
    return checks.unique_combination(td.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_unique", """SELECT tx_hash, count(1) AS n_records FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS tx_hash FROM lineitem) WHERE tx_hash IS NOT NULL
GROUP BY 1 HAVING count(1) > 1""")
def q_check_unique(spark, d):
    """TEST-3: normalised Solana-style transfers repeat tx ids (Q14 shape)."""
    return checks.unique(_normalised(spark, d)[1], "tx_hash")


@register("check_accepted_values", """SELECT o_orderstatus, count(1) AS n_records FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY 1""")
def q_check_accepted_values(spark, d):
    """TEST-4: order status outside the accepted list."""
    return checks.accepted_values(td.read(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@register("check_relationships", """SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def q_check_relationships(spark, d):
    """TEST-5: orders whose customer does not exist."""
    return checks.relationships(td.read(spark, d, "orders"), "o_custkey",
                                td.read(spark, d, "customer"), "c_custkey")


@register("check_custom", """SELECT * FROM lineitem WHERE l_discount > 0.1 OR l_tax < 0""")
def q_check_custom(spark, d):
    """TEST-6: a custom failing-row predicate."""
    return checks.custom(td.read(spark, d, "lineitem"),
                         (F.col("l_discount") > 0.1) | (F.col("l_tax") < 0))


@register("check_relationships_orphans", """SELECT * FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def q_check_relationships_orphans(spark, d):
    """TEST-5 with failing rows: orders whose customer is not among those in credit."""
    in_credit = td.read(spark, d, "customer").filter("c_acctbal >= 0")
    return checks.relationships(td.read(spark, d, "orders"), "o_custkey", in_credit, "c_custkey")


@register("check_custom_rows", "SELECT * FROM lineitem WHERE l_discount >= 0.09 AND l_tax >= 0.07")
def q_check_custom_rows(spark, d):
    """TEST-6 with failing rows."""
    return checks.custom(td.read(spark, d, "lineitem"), (F.col("l_discount") >= 0.09) & (F.col("l_tax") >= 0.07))


@register("surrogate_key", """SELECT l_orderkey, l_linenumber, md5(concat_ws('-',
  coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
  coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS surrogate_key
FROM lineitem""")
def q_surrogate_key(spark, d):
    """PRJ-19: md5 over '-'-joined key columns with a NULL marker."""
    li = td.read(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     surrogate_key("l_orderkey", "l_linenumber").alias("surrogate_key"))


# ------------------------------------------------------------ declared model tests

def _declared_sql() -> str:
    src = f"({NORM_LINEITEM_SQL})"
    parts = [f"""SELECT 'not_null_dbt_tether_solana_{c}' AS test, count(*) AS n_failed
  FROM {src} WHERE "{c}" IS NULL""" for c in ("dt", "period", "from", "to", "tx_hash", "evt_index")]
    parts.append(f"""SELECT 'unique_combination_dbt_tether_solana_tx_hash__evt_index' AS test,
  count(*) AS n_failed FROM (SELECT tx_hash, evt_index FROM {src} GROUP BY 1, 2 HAVING count(*) > 1)""")
    return "\nUNION ALL\n".join(parts)


@register("check_declared_transfers", _declared_sql())
def q_check_declared_transfers(spark, d):
    """§5: the project's declared tests on a Solana-style transfer table
    (the (tx_hash, evt_index) key fails by design: tx_index is the position
    of the transaction, not of the transfer)."""
    return checks.run_declared("dbt_tether_solana", _normalised(spark, d)[1])


# ------------------------------------------------------------ approximate-distinct accuracy

# Three standard errors of 1 % each.
HLL_SLACK = 0.03


@register("stats_weekly_checked", f"""SELECT * EXCLUDE (senders, receivers),
  true AS senders_within_bound, true AS receivers_within_bound
FROM ({_stats_sql('week')})""")
def q_stats_weekly_checked(spark, d):
    """P-37 with a value check: every exact measure of the weekly stats, and
    whether the HLL++ (1 % standard error) sender / receiver counts are within
    three standard errors of the exact counts."""
    norm = _normalised(spark, d)
    approx = transfer_stats(norm, "week", "approx", rsd=0.01)
    exact = transfer_stats(norm, "week", "exact").select(
        "period", "blockchain", F.col("senders").alias("_es"), F.col("receivers").alias("_er"))

    def within(a, e):
        return F.abs(F.col(a) - F.col(e)) <= F.greatest(F.col(e) * F.lit(HLL_SLACK), F.lit(1.0))

    j = approx.join(exact, ["period", "blockchain"])
    return j.select(*[c for c in approx.columns if c not in ("senders", "receivers")],
                    within("senders", "_es").alias("senders_within_bound"),
                    within("receivers", "_er").alias("receivers_within_bound"))
