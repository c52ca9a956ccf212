"""Seed tables: small CSV dimensions read with an explicit schema.

A seed knows its own row count, which is what allows it to be broadcast
without guessing (see ``operators.joins.bounded_broadcast``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.functions.address import canonical_address
from flowlake.operators.joins import bounded_broadcast

YIELD_TOKENS_SCHEMA = T.StructType([
    T.StructField("protocol", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("chain", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("token_address", T.StringType()),
    T.StructField("token_name", T.StringType()),
    T.StructField("token_decimals", T.IntegerType()),
    T.StructField("underlying_token_address", T.StringType()),
    T.StructField("underlying_token_name", T.StringType()),
    T.StructField("underlying_token_decimals", T.IntegerType()),
    T.StructField("start_date", T.DateType()),
])

RWA_TOKENS_SCHEMA = T.StructType([
    T.StructField("protocol", T.StringType()),
    T.StructField("blockchain", T.StringType()),
    T.StructField("token_address", T.StringType()),
    T.StructField("token_name", T.StringType()),
    T.StructField("token_decimals", T.IntegerType()),
    T.StructField("start_date", T.DateType()),
])

SPL_TOKENS_SCHEMA = T.StructType([
    T.StructField("protocol", T.StringType()),
    T.StructField("mint_address", T.StringType()),
    T.StructField("token_name", T.StringType()),
    T.StructField("token_decimals", T.IntegerType()),
    T.StructField("start_date", T.DateType()),
])

ADDRESS_LABELS_SCHEMA = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("protocol", T.StringType()),
])

# Which columns hold EVM hex addresses (canonicalised on read). Solana mint
# addresses are base58 and case-sensitive, so they are left as they are.
HEX_COLUMNS = {
    "yield_tokens": ["token_address", "underlying_token_address"],
    "rwa_tokens": ["token_address"],
    "spl_tokens": [],
    "address_labels": ["address"],
}


@dataclass
class Seed:
    df: DataFrame
    rows: int

    def broadcast(self) -> DataFrame:
        return bounded_broadcast(self.df, known_rows=self.rows)


def seed_from_df(df: DataFrame, kind: str, rows: int | None = None) -> Seed:
    """Canonicalise hex columns and attach the row count."""
    for c in HEX_COLUMNS.get(kind, []):
        df = df.withColumn(c, canonical_address(c))
    if kind == "spl_tokens" and "mint_address" in df.columns:
        df = df.withColumnRenamed("mint_address", "token_address")
    return Seed(df, rows if rows is not None else df.count())


def read_seed(spark: SparkSession, path: str, kind: str) -> Seed:
    schema = {
        "yield_tokens": YIELD_TOKENS_SCHEMA, "rwa_tokens": RWA_TOKENS_SCHEMA,
        "spl_tokens": SPL_TOKENS_SCHEMA, "address_labels": ADDRESS_LABELS_SCHEMA,
    }[kind]
    df = spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    # A seed is a few dozen rows: counting it is one tiny job and bounds the broadcast.
    return seed_from_df(df, kind)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Small inline table built JVM-side (no Python RDD, no Python worker)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def seed_from_rows(spark: SparkSession, rows: list[tuple], kind: str) -> Seed:
    schema = {
        "yield_tokens": YIELD_TOKENS_SCHEMA, "rwa_tokens": RWA_TOKENS_SCHEMA,
        "spl_tokens": SPL_TOKENS_SCHEMA, "address_labels": ADDRESS_LABELS_SCHEMA,
    }[kind]
    return seed_from_df(literal_table(spark, rows, schema), kind, rows=len(rows))



def dedupe_seed(seed: Seed, keys: list[str]) -> Seed:
    """One row per key (e.g. chain + canonical address).

    Seed rows that differ only in hex case become equal after
    canonicalisation and would double every joined flow. The row kept is the
    one with the earliest start_date (then the smallest name), so the choice
    is deterministic. The row count stays a valid upper bound.
    """
    cols = seed.df.columns
    rest = [c for c in cols if c not in keys]
    order = F.struct(*[F.col(c) for c in ("start_date", "token_name") if c in cols])
    picked = (seed.df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
              .select(*keys, "_row.*"))
    return Seed(picked.select(*cols), seed.rows)
