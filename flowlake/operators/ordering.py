"""Proof that a written table is in order, and global row numbers without a global sort.

A sorted write gives files whose names follow the order.  Reading them back,

- inside a file, a lag pass compares each row with the one before it,
- across files, the last key of a file is compared with the first of the next
  (one row per file),
- a row's number is the rows of all files before its own, plus its place there.

No step gathers rows: windows run inside one file, and the table of files has one
row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Key = tuple[str, bool]      # column, descending (NULLs last in both directions)


def _rank(col: Column, descending: bool, other: Column) -> Column:
    """True where ``col`` may stand before ``other`` under this key alone; NULL-safe."""
    before = col > other if descending else col < other
    return F.when(col.isNull(), F.lit(False)).when(other.isNull(), F.lit(True)).otherwise(before)


def in_order(prev: list[Column], this: list[Column], keys: list[Key]) -> Column:
    """Whether the key ``prev`` comes before ``this`` or equals it."""
    out = F.lit(True)
    for p, t, (_, descending) in reversed(list(zip(prev, this, keys))):
        out = _rank(p, descending, t) | (p.eqNullSafe(t) & out)
    return out


def read_with_places(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows with ``_file`` (name) and ``_place`` (from 0) in it."""
    return spark.read.schema(schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))


def file_summary(rows: DataFrame, keys: list[Key]) -> DataFrame:
    """One row per file: rows, first and last key, the rows of the files before it, and
    whether the file before it ends at or before its first key."""
    cols = F.struct(*(F.col(c).alias(c) for c, _ in keys))
    files = rows.groupBy("_file").agg(F.count("*").alias("rows"), F.min_by(cols, "_place").alias("first"),
                                      F.max_by(cols, "_place").alias("last"))
    by_name = Window.orderBy("_file")       # one row per file
    prev = F.lag("last").over(by_name)
    meets = in_order([prev[c] for c, _ in keys], [F.col("first")[c] for c, _ in keys], keys)
    before = F.coalesce(F.sum("rows").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.select("_file", "rows", "first", "last", before.alias("before"),
                        F.when(prev.isNull(), F.lit(True)).otherwise(meets).alias("border_ok"))


def numbered(rows: DataFrame, keys: list[Key], number: str = "row_no", flag: str = "order_ok") -> DataFrame:
    """Rows with their global number (from 1) and whether each follows the row before it."""
    files = file_summary(rows, keys).select(F.col("_file").alias("_f"), "before", "border_ok")
    inside = Window.partitionBy("_file").orderBy("_place")
    prev = F.lag(F.struct(*(F.col(c).alias(c) for c, _ in keys))).over(inside)
    follows = in_order([prev[c] for c, _ in keys], [F.col(c) for c, _ in keys], keys)
    checked = rows.withColumn("_follows", F.when(F.col("_place") == 0, F.lit(None)).otherwise(follows))
    return (checked.join(files, F.col("_file") == F.col("_f"))
            .withColumn(number, F.col("before") + F.col("_place") + 1)
            .withColumn(flag, F.coalesce(F.col("_follows"), F.col("border_ok")))
            .drop("_file", "_place", "_f", "_follows", "before", "border_ok"))


def is_sorted(rows: DataFrame, keys: list[Key]) -> bool:
    return numbered(rows, keys).filter(~F.col("order_ok")).isEmpty()


def order_by(keys: list[Key]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in keys]


