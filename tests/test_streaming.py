"""The incremental model as a stream: restarts resume, and late rows of any age count."""

import datetime as dt
import os

from flowlake.streaming import stream_tx_per_block

SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def add_file(spark, src, name, times):
    rows = [(i, t, 1) for i, t in enumerate(times)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))


def counts(spark, target):
    return {(r["block_number"], r["block_date"]): r["total_tx_per_block"]
            for r in spark.read.parquet(target).collect()}


def test_stream_counts_late_rows_of_any_age(spark, tmp_dir):
    src, target, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "target", "ckpt"))
    t = dt.datetime
    add_file(spark, src, "f1", [t(2024, 1, 10, 5), t(2024, 1, 10, 5, 30), t(2024, 1, 10, 6)])
    stream_tx_per_block(spark, f"{src}/*", SCHEMA, target, checkpoint=ckpt).awaitTermination()
    assert counts(spark, target) == {(2024011005, dt.date(2024, 1, 10)): 2,
                                     (2024011006, dt.date(2024, 1, 10)): 1}

    add_file(spark, src, "f2", [t(2024, 1, 10, 5, 45),   # late
                                t(2024, 1, 11, 1),          # new hour
                                t(2024, 1, 5, 1), None])    # days late, and no time
    stream_tx_per_block(spark, f"{src}/*", SCHEMA, target, checkpoint=ckpt).awaitTermination()
    assert counts(spark, target) == {(2024011005, dt.date(2024, 1, 10)): 3,
                                     (2024011006, dt.date(2024, 1, 10)): 1,
                                     (2024011101, dt.date(2024, 1, 11)): 1,
                                     (2024010501, dt.date(2024, 1, 5)): 1}


def test_default_checkpoint_is_the_same_on_restart(spark, tmp_dir):
    src, target = (os.path.join(tmp_dir, x) for x in ("src2", "target2"))
    add_file(spark, src, "f1", [dt.datetime(2024, 1, 10, 5)])
    for _ in range(2):
        q = stream_tx_per_block(spark, f"{src}/*", SCHEMA, target)
        q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 0
    assert counts(spark, target) == {(2024011005, dt.date(2024, 1, 10)): 1}
