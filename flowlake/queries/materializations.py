"""Materializations on Parquet and the streaming model (SINK-*, P-39)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from flowlake.plans.blocks import PARTITION_BY, tx_per_block, UNIQUE_KEY
from flowlake.session import workspace_dir
from flowlake.sinks import append_dedup, compact, delete_insert, merge, write_table
from flowlake.sources import testdata as td, testdata_sql as tsql
from flowlake.streaming import stream_tx_per_block

from flowlake.queries.registry import ORACLES, register


# ------------------------------------------------------------ materializations

# Fixed values of the incremental scenario: the first run sees data up to
# RUN1_AS_OF except 'view' events dated from LATE_FROM (they arrive late);
# the second run re-reads everything from WINDOW_START.
RUN1_AS_OF = _dt.date(2024, 1, 27)
LATE_FROM = _dt.date(2024, 1, 25)
WINDOW_START = _dt.date(2024, 1, 26)
MERGE_PREDICATE_FROM = _dt.date(2024, 1, 27)


def _blocks(spark, d) -> DataFrame:
    ev = td.read(spark, d, "events")
    return ev.select(F.date_format("ts", "yyyyMMddHH").cast("bigint").alias("block_number"),
                     F.to_date("ts").alias("block_date"), "event_type")


def _run1_blocks(blocks: DataFrame) -> DataFrame:
    late = (F.col("event_type") == "view") & (F.col("block_date") >= F.lit(LATE_FROM))
    return blocks.filter((F.col("block_date") <= F.lit(RUN1_AS_OF)) & ~late)


def _first_run(spark, d, path) -> None:
    write_table(spark, tx_per_block(_run1_blocks(_blocks(spark, d))), path, PARTITION_BY)


_BLOCKS_SQL = f"""SELECT CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS block_number,
  CAST(ts AS DATE) AS block_date, event_type FROM events"""
_T1_SQL = f"""SELECT block_number, block_date, count(1) AS total_tx_per_block FROM ({_BLOCKS_SQL})
WHERE block_date <= DATE '{RUN1_AS_OF}'
  AND NOT (event_type = 'view' AND block_date >= DATE '{LATE_FROM}') GROUP BY 1, 2"""
_BATCH_SQL = f"""SELECT block_number, block_date, count(1) AS total_tx_per_block FROM ({_BLOCKS_SQL})
WHERE block_date >= DATE '{WINDOW_START}' GROUP BY 1, 2"""


def _replace_sql(pred_from: _dt.date) -> str:
    return f"""WITH t1 AS ({_T1_SQL}), b AS ({_BATCH_SQL})
SELECT * FROM t1 WHERE NOT (t1.block_date >= DATE '{pred_from}' AND EXISTS (
  SELECT 1 FROM b WHERE b.block_number = t1.block_number AND b.block_date = t1.block_date))
UNION ALL SELECT * FROM b"""


@register("tx_per_block", f"""SELECT block_number, block_date, count(1) AS total_tx_per_block
FROM ({tsql.EVENTS_BLOCKS}) GROUP BY 1, 2""")
def q_tx_per_block(spark, d):
    """P-39: transactions per block (events per hour)."""
    return tx_per_block(td.events_blocks(td.read(spark, d, "events")))


@register("inc_full_refresh", f"""SELECT block_number, block_date, count(1) AS total_tx_per_block
FROM ({tsql.EVENTS_BLOCKS}) GROUP BY 1, 2""")
def q_inc_full_refresh(spark, d):
    """SINK-2/3: first run, then a full refresh replaces the whole partitioned table."""
    path = workspace_dir(spark, "inc_full_refresh")
    _first_run(spark, d, path)
    return write_table(spark, tx_per_block(_blocks(spark, d)), path, PARTITION_BY)


@register("inc_delete_insert", _replace_sql(WINDOW_START))
def q_inc_delete_insert(spark, d):
    """SINK-4: lookback batch replaces matching keys inside the predicate window."""
    path = workspace_dir(spark, "inc_delete_insert")
    _first_run(spark, d, path)
    batch = tx_per_block(_blocks(spark, d), since=WINDOW_START)
    return delete_insert(spark, batch, path, UNIQUE_KEY, PARTITION_BY,
                         predicate=F.col("block_date") >= F.lit(WINDOW_START))


@register("inc_merge", _replace_sql(WINDOW_START))
def q_inc_merge(spark, d):
    """SINK-5: matched rows updated, new rows inserted."""
    path = workspace_dir(spark, "inc_merge")
    _first_run(spark, d, path)
    batch = tx_per_block(_blocks(spark, d), since=WINDOW_START)
    return merge(spark, batch, path, UNIQUE_KEY, PARTITION_BY,
                 dest_predicate=F.col("block_date") >= F.lit(WINDOW_START))


@register("inc_merge_predicate_dup", _replace_sql(MERGE_PREDICATE_FROM))
def q_inc_merge_predicate_dup(spark, d):
    """SINK-5 quirk: a destination predicate narrower than the batch duplicates keys."""
    path = workspace_dir(spark, "inc_merge_predicate_dup")
    _first_run(spark, d, path)
    batch = tx_per_block(_blocks(spark, d), since=WINDOW_START)
    return merge(spark, batch, path, UNIQUE_KEY, PARTITION_BY,
                 dest_predicate=F.col("block_date") >= F.lit(MERGE_PREDICATE_FROM))


@register("inc_append_dedup", f"""WITH t1 AS ({_T1_SQL}), b AS ({_BATCH_SQL})
SELECT * FROM t1
UNION ALL SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM t1 WHERE t1.block_number = b.block_number AND t1.block_date = b.block_date
    AND t1.block_date >= DATE '{WINDOW_START}')""")
def q_inc_append_dedup(spark, d):
    """SINK-6: only keys absent from the recent target window are appended."""
    path = workspace_dir(spark, "inc_append_dedup")
    _first_run(spark, d, path)
    batch = tx_per_block(_blocks(spark, d), since=WINDOW_START)
    return append_dedup(spark, batch, path, UNIQUE_KEY, PARTITION_BY,
                        target_window=F.col("block_date") >= F.lit(WINDOW_START))


def _filtered(name: str, write, window: str):
    """JOIN-11: the same batch with its key filter before the anti join: the same rows."""
    @register(f"{name}_filtered", ORACLES[name])
    def query(spark, d):
        path = workspace_dir(spark, f"{name}_filtered")
        _first_run(spark, d, path)
        batch = tx_per_block(_blocks(spark, d), since=WINDOW_START)
        recent = {window: F.col("block_date") >= F.lit(WINDOW_START)}
        return write(spark, batch, path, UNIQUE_KEY, PARTITION_BY, filter_keys=True, **recent)
    return query


q_inc_delete_insert_filtered = _filtered("inc_delete_insert", delete_insert, "predicate")
q_inc_merge_filtered = _filtered("inc_merge", merge, "dest_predicate")
q_inc_append_dedup_filtered = _filtered("inc_append_dedup", append_dedup, "target_window")


_NULL_BLOCK = "CASE WHEN event_type = 'error' THEN NULL ELSE block_number END"


@register("inc_null_key_dup", f"""WITH b AS (
  SELECT {_NULL_BLOCK} AS block_number, block_date, count(1) AS total_tx_per_block
  FROM ({_BLOCKS_SQL}) WHERE block_date >= DATE '{WINDOW_START}' GROUP BY 1, 2)
SELECT * FROM b UNION ALL SELECT * FROM b WHERE block_number IS NULL""")
def q_inc_null_key_dup(spark, d):
    """SINK-8: the same batch loaded twice; rows with a NULL key never match and double."""
    path = workspace_dir(spark, "inc_null_key_dup")
    blocks = _blocks(spark, d).withColumn(
        "block_number", F.when(F.col("event_type") == "error", None).otherwise(F.col("block_number")))
    batch = tx_per_block(blocks, since=WINDOW_START)
    delete_insert(spark, batch, path, UNIQUE_KEY, PARTITION_BY, null_keys="keep")
    return delete_insert(spark, batch, path, UNIQUE_KEY, PARTITION_BY, null_keys="keep")


@register("inc_null_keys_dropped", f"""SELECT {_NULL_BLOCK} AS block_number, block_date, count(1) AS total_tx_per_block
FROM ({_BLOCKS_SQL}) WHERE event_type <> 'error' GROUP BY 1, 2""")
def q_inc_null_keys_dropped(spark, d):
    """PRJ-18: rows with a NULL key are filtered out of a first run and of the increment after it."""
    path = workspace_dir(spark, "inc_null_keys_dropped")
    blocks = _blocks(spark, d).withColumn(
        "block_number", F.when(F.col("event_type") == "error", None).otherwise(F.col("block_number")))
    write_table(spark, tx_per_block(blocks.filter(F.col("block_date") <= F.lit(RUN1_AS_OF))), path, PARTITION_BY,
                unique_key=UNIQUE_KEY, null_keys="drop")
    return delete_insert(spark, tx_per_block(blocks, since=WINDOW_START), path, UNIQUE_KEY, PARTITION_BY, null_keys="drop")


_TWO_PARTS = """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_type <> 'error' THEN event_type END AS kind, {value} AS v
FROM events"""


@register("inc_null_partition", f"""WITH old AS ({_TWO_PARTS.format(value="0")}),
batch AS ({_TWO_PARTS.format(value="1")} WHERE event_id % 3 = 0)
SELECT * FROM batch UNION ALL SELECT * FROM old
WHERE NOT EXISTS (SELECT 1 FROM batch WHERE batch.event_id = old.event_id AND batch.day = old.day AND batch.kind = old.kind)""")
def q_inc_null_partition(spark, d):
    """SINK-4 / SINK-8: two partition columns, one of them NULL for some rows, whose old rows stay."""
    path = workspace_dir(spark, "inc_null_partition")
    ev = td.read(spark, d, "events").select(
        "event_id", F.to_date("ts").alias("day"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    write_table(spark, ev.withColumn("v", F.lit(0)), path, ["day", "kind"])
    batch = ev.filter("event_id % 3 = 0").withColumn("v", F.lit(1))
    out = delete_insert(spark, batch, path, ["event_id", "day", "kind"], ["day", "kind"], null_keys="keep")
    return out.select("event_id", "day", "kind", "v")


@register("table_drop_mode", f"""SELECT block_number, block_date, count(1) AS total_tx_per_block
FROM ({tsql.EVENTS_BLOCKS}) GROUP BY 1, 2""")
def q_table_drop_mode(spark, d):
    """SINK-2 with on_table_exists='drop': the old table goes before the new one is written."""
    path = workspace_dir(spark, "table_drop_mode")
    _first_run(spark, d, path)
    return write_table(spark, tx_per_block(_blocks(spark, d)), path, PARTITION_BY, on_table_exists="drop")


@register("compact_partitions", _T1_SQL)
def q_compact_partitions(spark, d):
    """SINK-10: many small files per partition rewritten into few; content unchanged."""
    path = workspace_dir(spark, "compact_partitions")
    tx_per_block(_run1_blocks(_blocks(spark, d))).repartition(16).write.partitionBy(
        *PARTITION_BY).parquet(path)
    return compact(spark, path, PARTITION_BY)


# ------------------------------------------------------------ streaming

@register("stream_tx_per_block", f"""SELECT block_number, block_date, count(1) AS total_tx_per_block
FROM ({tsql.EVENTS_BLOCKS}) GROUP BY 1, 2""")
def q_stream_tx_per_block(spark, d):
    """P-39 as a stream: the days a micro-batch touches are counted again and replaced."""
    target = workspace_dir(spark, "stream_tx_per_block")
    schema = td.read(spark, d, "events").schema
    q = stream_tx_per_block(spark, f"{d}/events*.parquet", schema, target)
    q.awaitTermination()
    return spark.read.parquet(target).select("block_number", "block_date", "total_tx_per_block")
