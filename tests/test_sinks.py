"""Materialization semantics: idempotence, incremental ≡ full rebuild, quirks."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from flowlake.plans.blocks import PARTITION_BY, UNIQUE_KEY, tx_per_block
from flowlake.sinks import append_dedup, compact, delete_insert, merge, write_table

SCHEMA = "block_number long, block_date date, total_tx_per_block long"


def blocks(spark, days, extra=()):
    data = [(d * 100 + h, dt.date(2024, 1, d)) for d in days for h in range(3)] + list(extra)
    return spark.createDataFrame(data, "block_number long, block_date date")


def content(df):
    return sorted(tuple(r) for r in df.select("block_number", "block_date", "total_tx_per_block").collect())


def test_delete_insert_twice_equals_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    batch = tx_per_block(blocks(spark, [1, 2]))
    once = content(delete_insert(spark, batch, path, UNIQUE_KEY, PARTITION_BY))
    twice = content(delete_insert(spark, batch, path, UNIQUE_KEY, PARTITION_BY))
    assert once == twice and len(once) == 6


def test_incremental_equals_full_rebuild_within_lookback(spark, tmp_dir):
    late = [(300, dt.date(2024, 1, 3))]  # arrives after the first run
    first = blocks(spark, [1, 2, 3])
    full_data = blocks(spark, [1, 2, 3, 4], extra=late)
    inc_path, full_path = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    write_table(spark, tx_per_block(first), inc_path, PARTITION_BY)
    since = dt.date(2024, 1, 3)  # lookback reaches the late row
    delete_insert(spark, tx_per_block(full_data, since=since), inc_path, UNIQUE_KEY, PARTITION_BY,
                  predicate=F.col("block_date") >= F.lit(since))
    write_table(spark, tx_per_block(full_data), full_path, PARTITION_BY)
    assert content(spark.read.parquet(inc_path)) == content(spark.read.parquet(full_path))


def test_merge_rejects_duplicate_batch_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    batch = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1), (1, dt.date(2024, 1, 1), 2)], SCHEMA)
    with pytest.raises(ValueError):
        merge(spark, batch, path, UNIQUE_KEY, PARTITION_BY)


def test_merge_updates_and_inserts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m2")
    write_table(spark, spark.createDataFrame([(1, dt.date(2024, 1, 1), 1), (2, dt.date(2024, 1, 2), 1)], SCHEMA),
                path, PARTITION_BY)
    batch = spark.createDataFrame([(2, dt.date(2024, 1, 2), 9), (3, dt.date(2024, 1, 2), 1)], SCHEMA)
    out = content(merge(spark, batch, path, UNIQUE_KEY, PARTITION_BY))
    assert out == [(1, dt.date(2024, 1, 1), 1), (2, dt.date(2024, 1, 2), 9), (3, dt.date(2024, 1, 2), 1)]


def test_null_keys_rejected_by_default(spark, tmp_dir):
    batch = spark.createDataFrame([(None, dt.date(2024, 1, 1), 1)], SCHEMA)
    with pytest.raises(ValueError):
        delete_insert(spark, batch, os.path.join(tmp_dir, "n"), UNIQUE_KEY, PARTITION_BY)


def test_partition_columns_must_be_in_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1)], SCHEMA)
    write_table(spark, df, path, PARTITION_BY)
    with pytest.raises(ValueError):
        delete_insert(spark, df, path, ["block_number"], PARTITION_BY)


def test_append_dedup_never_updates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "a")
    write_table(spark, spark.createDataFrame([(1, dt.date(2024, 1, 1), 1)], SCHEMA), path, PARTITION_BY)
    batch = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5), (2, dt.date(2024, 1, 1), 1)], SCHEMA)
    out = content(append_dedup(spark, batch, path, UNIQUE_KEY, PARTITION_BY))
    assert out == [(1, dt.date(2024, 1, 1), 1), (2, dt.date(2024, 1, 1), 1)]


def test_untouched_partitions_are_not_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "u")
    write_table(spark, tx_per_block(blocks(spark, [1, 2])), path, PARTITION_BY)
    before = sorted(glob.glob(os.path.join(path, "block_date=2024-01-01", "*.parquet")))
    delete_insert(spark, tx_per_block(blocks(spark, [2])), path, UNIQUE_KEY, PARTITION_BY)
    after = sorted(glob.glob(os.path.join(path, "block_date=2024-01-01", "*.parquet")))
    assert before == after


def test_compact_keeps_content(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c")
    tx_per_block(blocks(spark, [1, 2, 3])).repartition(12).write.partitionBy(*PARTITION_BY).parquet(path)
    n_before = len(glob.glob(os.path.join(path, "*", "*.parquet")))
    before = content(spark.read.parquet(path))
    after = content(compact(spark, path, PARTITION_BY))
    assert before == after
    assert len(glob.glob(os.path.join(path, "*", "*.parquet"))) < n_before


def test_materialize_first_run_then_incremental(spark, tmp_dir):
    from flowlake.context import RunContext
    from flowlake.sinks import materialize

    path = os.path.join(tmp_dir, "mat")
    data = {"rows": blocks(spark, [1, 2])}
    seen = []

    def build(ctx):
        seen.append(ctx.incremental)
        return tx_per_block(data["rows"], since=ctx.window_start if ctx.incremental else None)

    ctx = RunContext(as_of=dt.date(2024, 1, 3), lookback_days=1)
    materialize(spark, build, path, ctx, "delete+insert", UNIQUE_KEY, PARTITION_BY)
    data["rows"] = blocks(spark, [1, 2, 3])
    out = materialize(spark, build, path, ctx, "delete+insert", UNIQUE_KEY, PARTITION_BY)
    assert seen == [False, True]
    assert out.count() == 9
    materialize(spark, build, path, ctx, "delete+insert", UNIQUE_KEY, PARTITION_BY, full_refresh=True)
    assert seen[-1] is False


def test_write_table_drop_mode(spark, tmp_dir):
    path = os.path.join(tmp_dir, "drop")
    write_table(spark, tx_per_block(blocks(spark, [1, 2])), path, PARTITION_BY)
    out = write_table(spark, tx_per_block(blocks(spark, [3])), path, PARTITION_BY, on_table_exists="drop")
    assert {r["block_date"] for r in out.collect()} == {dt.date(2024, 1, 3)}


def test_empty_partitioned_results_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    empty = spark.createDataFrame([], SCHEMA)
    assert write_table(spark, empty, path, PARTITION_BY).count() == 0
    assert delete_insert(spark, empty, path, UNIQUE_KEY, PARTITION_BY).count() == 0
    assert compact(spark, path, PARTITION_BY, schema=empty.schema).count() == 0
    out = delete_insert(spark, tx_per_block(blocks(spark, [1])), path, UNIQUE_KEY, PARTITION_BY)
    assert out.count() == 3


TWO_PARTS = "k long, p string, q string, v long"


def two_part_rows(df):
    return sorted((r["k"], r["p"] or "", r["q"] or "", r["v"]) for r in df.collect())


@pytest.mark.parametrize("parts", [["p"], ["p", "q"]])
def test_null_partition_keeps_its_rows(spark, tmp_dir, parts):
    path = os.path.join(tmp_dir, "null-part")
    write_table(spark, spark.createDataFrame([(1, None, "x", 1), (2, None, "x", 1), (3, "a", None, 1), (4, "a", None, 1)], TWO_PARTS), path, parts)
    batch = spark.createDataFrame([(1, None, "x", 9), (3, "a", None, 9)], TWO_PARTS)
    out = two_part_rows(delete_insert(spark, batch, path, ["k", "p", "q"], parts, null_keys="keep"))
    # NULL never matches: the old rows of keys 1 and 3 stay beside the new ones
    assert out == [(1, "", "x", 1), (1, "", "x", 9), (2, "", "x", 1), (3, "a", "", 1), (3, "a", "", 9), (4, "a", "", 1)]


def test_many_touched_partitions_keep_their_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many")
    schema = "k long, p long"
    write_table(spark, spark.createDataFrame([(1, i) for i in range(40)] + [(1, None)], schema), path, ["p"])
    batch = spark.createDataFrame([(2, i) for i in range(40)] + [(2, None)], schema)
    assert delete_insert(spark, batch, path, ["k", "p"], ["p"], null_keys="keep").count() == 82


def test_refused_rename_keeps_the_old_table(spark, tmp_dir, monkeypatch):
    from flowlake.sinks import writers

    path = os.path.join(tmp_dir, "kept")
    old = content(write_table(spark, tx_per_block(blocks(spark, [1, 2])), path, PARTITION_BY))

    class Refusing:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False if "-stage-" in a.toString() else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = writers._move_in
    monkeypatch.setattr(writers, "_move_in", lambda fs, *a: real(Refusing(fs), *a))
    with pytest.raises(OSError):
        write_table(spark, tx_per_block(blocks(spark, [3])), path, PARTITION_BY)
    with pytest.raises(OSError):
        delete_insert(spark, tx_per_block(blocks(spark, [2])), path, UNIQUE_KEY, PARTITION_BY)
    assert content(spark.read.parquet(path)) == old
    assert [f for f in os.listdir(tmp_dir) if f.startswith("_")] == []


def test_null_keys_can_be_dropped_and_are_checked_on_the_first_run(spark, tmp_dir):
    from flowlake.context import RunContext
    from flowlake.sinks import materialize

    rows = spark.createDataFrame([(None, dt.date(2024, 1, 1), 1), (5, dt.date(2024, 1, 1), 1)], SCHEMA)
    out = delete_insert(spark, rows, os.path.join(tmp_dir, "d"), UNIQUE_KEY, PARTITION_BY, null_keys="drop")
    assert content(out) == [(5, dt.date(2024, 1, 1), 1)]
    ctx = RunContext(as_of=dt.date(2024, 1, 3), lookback_days=1)
    path = os.path.join(tmp_dir, "first")
    with pytest.raises(ValueError):
        materialize(spark, lambda c: rows, path, ctx, "delete+insert", UNIQUE_KEY, PARTITION_BY)
    assert not os.path.exists(path)
