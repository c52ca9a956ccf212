"""Materializations on plain Parquet folders.

Parquet folders have no row-level DELETE / MERGE, so every strategy is a
DataFrame rewrite:

* only the partitions a batch touches are rewritten (partition columns must
  be part of the unique key, so untouched partitions cannot change);
* the batch is written once, in the table's partition layout, to a staging
  folder beside the target (same file system, so a move is a rename); checks
  and the rewrite read those files, and the surviving target rows of the
  touched partitions are added to it;
* finished partition folders are then moved in: the old folder steps aside
  first and comes back if its replacement cannot be moved; it is deleted only
  when the new one is in place.

Unpartitioned targets are swapped whole, the same way. Like the source
warehouse's DELETE-then-INSERT, publishing is not atomic across partitions.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.sinks.keyfilter import key_filter, unmatched

MOVES = 16      # partition folders moved at a time


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a written table with its known schema.

    An empty result written with ``partitionBy`` leaves no data files, so
    the schema cannot be inferred from the folder; the writer knows it.
    """
    return spark.read.schema(schema).parquet(path)


def _beside(path: str, what: str) -> str:
    """A fresh folder name next to ``path``; readers skip names that start with "_"."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{what}-{uuid.uuid4().hex[:12]}"


def _writer(df: DataFrame, partition_by: list[str] | None):
    if partition_by:
        # REBALANCE: AQE splits a hot partition value over several tasks and
        # merges small ones, so one huge day does not become one huge task.
        return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    return df.write


def create_view(df: DataFrame, name: str) -> DataFrame:
    """SINK-1: a view is a named lazy plan, recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


def _move_in(fs, new, target, aside) -> None:
    """Put folder ``new`` in place of ``target``; the old one waits in ``aside`` until then."""
    had_old = fs.exists(target)
    if had_old:
        fs.mkdirs(aside.getParent())
        if not fs.rename(target, aside):
            raise OSError(f"could not move {target} aside; nothing was changed")
    else:
        fs.mkdirs(target.getParent())
    try:
        moved = fs.rename(new, target)
    except Exception:
        moved = False
    if not moved:
        if had_old and not fs.rename(aside, target):
            raise OSError(f"could not move {new} to {target}; the old content is in {aside}")
        raise OSError(f"could not move {new} to {target}; the old content is back in place")
    if had_old:
        fs.delete(aside, True)


def _publish(spark: SparkSession, stage: str, path: str, partition_by: list[str] | None) -> None:
    """Move the staged table, or each of its partition folders, into ``path``."""
    fs, target = _fs_path(spark, path)
    _, staged = _fs_path(spark, stage)
    _, aside = _fs_path(spark, _beside(path, "old"))
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not partition_by or not fs.exists(target):
        _move_in(fs, staged, target, aside)
        return
    folders = [staged]
    for _ in partition_by:
        folders = [f.getPath() for d in folders for f in fs.listStatus(d) if f.isDirectory()]
    root = staged.toUri().getPath().rstrip("/") + "/"


    def move(folder) -> None:
        inner = folder.toUri().getPath().removeprefix(root)
        _move_in(fs, folder, Path(target, inner), Path(aside, inner))

    try:
        # folders do not depend on each other; the first error is raised when all have ended
        with ThreadPoolExecutor(MOVES) as pool:
            for done in [pool.submit(move, f) for f in folders]:
                done.result()
    finally:
        # only a folder that could not be moved back is still in it
        if fs.exists(aside) and fs.getContentSummary(aside).getFileCount() == 0:
            fs.delete(aside, True)


def write_table(spark: SparkSession, df: DataFrame, path: str,
                partition_by: list[str] | None = None, on_table_exists: str = "rename",
                unique_key: list[str] | None = None, null_keys: str = "reject") -> DataFrame:
    """SINK-2: full rebuild.

    ``on_table_exists='rename'`` (default): written completely beside the
    target, then moved in, so readers never see a half-written table and
    file order (e.g. a sorted table) is kept. ``'drop'``: the old table is
    dropped first and the new one written in place (no staging space needed;
    readers see no table while it runs). ``df`` must not read ``path`` then.
    With a ``unique_key`` the keys of the written rows are checked as in the
    incremental strategies, before the table is replaced.
    """
    if unique_key:
        df = _without_null_keys(df, unique_key, null_keys)
    if on_table_exists == "drop":
        _remove(spark, path)
        _writer(df, partition_by).mode("overwrite").parquet(path)
        return _read(spark, path, df.schema)
    if on_table_exists != "rename":
        raise ValueError("on_table_exists must be 'rename' or 'drop'")
    stage = _beside(path, "stage")
    try:
        _writer(df, partition_by).mode("overwrite").parquet(stage)
        if unique_key:
            _check_null_keys(_read(spark, stage, df.schema), unique_key, null_keys)
        _publish(spark, stage, path, None)
    finally:
        _remove(spark, stage)
    return _read(spark, path, df.schema)


def _any_null(keys: list[str]) -> Column:
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return any_null


def _without_null_keys(batch: DataFrame, keys: list[str], null_keys: str) -> DataFrame:
    """PRJ-18: ``null_keys='drop'`` filters rows with a NULL in the key."""
    return batch.filter(~_any_null(keys)) if null_keys == "drop" else batch


def _check_null_keys(batch: DataFrame, keys: list[str], null_keys: str) -> None:
    if null_keys in ("keep", "drop"):
        return
    if null_keys != "reject":
        raise ValueError("null_keys must be 'reject', 'drop' or 'keep'")
    if batch.filter(_any_null(keys)).limit(1).count():
        raise ValueError(f"batch has NULL values in unique key {keys}; NULL keys never "
                         "match, so they would be inserted again on every run")


def _touched(spark: SparkSession, target: DataFrame, staged: DataFrame,
             partition_by: list[str] | None) -> DataFrame:
    """Restrict the target to the partitions the batch touches.

    The touched partition values are one row per folder that publishing moves.
    They become an ``IN`` list (and ``IS NULL``) per partition column – a
    partition filter, so the scan lists and reads only those folders (a 100 TB
    target touched on 3 days reads 3 days). With several partition columns the
    lists describe a superset, which an exact null-safe semi join trims.
    """
    if not partition_by:
        return target
    touched = staged.select(*partition_by).distinct()
    parts = touched.collect()
    if not parts:
        return target.limit(0)
    for c in partition_by:
        values = sorted({row[c] for row in parts if row[c] is not None})
        cond = F.col(c).isin(*values) if values else F.lit(False)
        if any(row[c] is None for row in parts):
            cond = cond | F.col(c).isNull()
        target = target.filter(cond)
    if len(partition_by) > 1:
        exact = spark.createDataFrame(parts, touched.schema).toDF(*(f"_touched_{c}" for c in partition_by))
        match = F.lit(True)
        for c in partition_by:
            match = match & F.col(c).eqNullSafe(F.col(f"_touched_{c}"))
        target = target.join(exact, match, "left_semi")
    return target


def _replace_keys(spark: SparkSession, batch: DataFrame, path: str, keys: list[str],
                  partition_by: list[str] | None, predicate: Column | None, null_keys: str,
                  one_row_per_key: bool, filter_keys: bool) -> DataFrame:
    """survivors(target) ∪ batch, restricted to the partitions the batch touches."""
    missing = set(partition_by or []) - set(keys)
    if missing:
        raise ValueError(f"partition columns {sorted(missing)} must be part of the unique key")
    batch = _without_null_keys(batch, keys, null_keys)
    stage = _beside(path, "stage")
    try:
        _writer(batch, partition_by).mode("overwrite").parquet(stage)
        staged = _read(spark, stage, batch.schema)
        _check_null_keys(staged, keys, null_keys)
        if one_row_per_key and staged.groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"merge batch has several rows for one key {keys}")
        if table_exists(spark, path):
            target = _touched(spark, _read(spark, path, batch.schema), staged, partition_by)
            if predicate is None:
                survivors = unmatched(target, staged, keys, filter_keys)
            else:
                # Rows outside the predicate never match; inside it, matched keys go.
                survivors = (target.filter(~predicate | predicate.isNull())
                             .unionByName(unmatched(target.filter(predicate), staged, keys, filter_keys)))
            _writer(survivors.select(*batch.columns), partition_by).mode("append").parquet(stage)
        _publish(spark, stage, path, partition_by)
    finally:
        _remove(spark, stage)
    return _read(spark, path, batch.schema)


def delete_insert(spark: SparkSession, batch: DataFrame, path: str, unique_key: list[str],
                  partition_by: list[str] | None = None, predicate: Column | None = None,
                  null_keys: str = "reject", filter_keys: bool = False) -> DataFrame:
    """SINK-4: delete target rows whose key is in the batch (and that satisfy
    ``predicate``), insert every batch row (duplicates inside a batch are kept).
    A missing target is created (first run / full refresh). ``filter_keys`` puts
    the batch's key filter before the anti join: for small batches into large partitions."""
    return _replace_keys(spark, batch, path, unique_key, partition_by, predicate, null_keys, False, filter_keys)


def merge(spark: SparkSession, batch: DataFrame, path: str, unique_key: list[str],
          partition_by: list[str] | None = None, dest_predicate: Column | None = None,
          null_keys: str = "reject", filter_keys: bool = False) -> DataFrame:
    """SINK-5: matched rows are replaced by the batch row, unmatched batch rows inserted.

    ``dest_predicate`` is part of the match condition: target rows failing it
    never match, so a batch row with their key is inserted as a duplicate
    (the source warehouse behaves the same). Several batch rows for one key
    are an error, as in SQL MERGE.
    """
    return _replace_keys(spark, batch, path, unique_key, partition_by, dest_predicate, null_keys, True, filter_keys)


def append_dedup(spark: SparkSession, batch: DataFrame, path: str, unique_key: list[str],
                 partition_by: list[str] | None = None,
                 target_window: Column | None = None, filter_keys: bool = False) -> DataFrame:
    """SINK-6: append batch rows whose key is absent from the (recent) target.

    Existing rows are never updated. ``target_window`` limits the target rows
    looked at (the source's time bound inside the anti join). New rows go to
    the table in one committed append; the target's files are listed before.
    ``filter_keys``: the batch is written beside the table first, and only target
    rows that its key filter lets through are joined.
    """
    if not table_exists(spark, path):
        return write_table(spark, batch, path, partition_by)
    target = _read(spark, path, batch.schema)
    if target_window is not None:
        target = target.filter(target_window)
    stage = _beside(path, "stage")
    try:
        if filter_keys:
            batch.write.parquet(stage)
            batch = _read(spark, stage, batch.schema)
            target = key_filter(batch, unique_key).candidates(target.select(*unique_key))
        new_rows = batch.join(target.select(*unique_key), unique_key, "left_anti").select(*batch.columns)
        _writer(new_rows, partition_by).mode("append").parquet(path)
    finally:
        _remove(spark, stage)
    return _read(spark, path, batch.schema)


def compact(spark: SparkSession, path: str, partition_by: list[str] | None = None, schema=None) -> DataFrame:
    """SINK-10: rewrite the table into fewer, larger files; content unchanged.

    Pass ``schema`` when the table may be empty (nothing to infer it from).
    """
    df = _read(spark, path, schema) if schema is not None else spark.read.parquet(path)
    stage = _beside(path, "stage")
    try:
        _writer(df, partition_by).mode("overwrite").parquet(stage)
        _publish(spark, stage, path, partition_by)
    finally:
        _remove(spark, stage)
    return _read(spark, path, df.schema)


def materialize(spark: SparkSession, build, path: str, ctx, strategy: str = "table",
                unique_key: list[str] | None = None, partition_by: list[str] | None = None,
                predicate: Column | None = None, full_refresh: bool = False,
                on_table_exists: str = "rename", null_keys: str = "reject") -> DataFrame:
    """Run a model the way an incremental materialization does.

    The incremental branch is taken only when the target exists, the
    strategy is incremental and no full refresh is asked for; otherwise the
    model is built in full mode and the table rebuilt. ``build`` maps a
    ``RunContext`` to the model's DataFrame.
    """
    from dataclasses import replace

    incremental = (strategy != "table" and not full_refresh and table_exists(spark, path))
    df = build(replace(ctx, incremental=incremental))
    if not incremental:
        checked = unique_key if strategy in ("delete+insert", "merge") else None
        return write_table(spark, df, path, partition_by, on_table_exists, checked, null_keys)
    if strategy == "delete+insert":
        return delete_insert(spark, df, path, unique_key, partition_by, predicate, null_keys)
    if strategy == "merge":
        return merge(spark, df, path, unique_key, partition_by, predicate, null_keys)
    if strategy == "append":
        return append_dedup(spark, df, path, unique_key, partition_by, predicate)
    raise ValueError(f"unknown strategy {strategy!r}")
