"""Key filter: no match lost, few false candidates, ranges in the target's scan, writers unchanged by it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from flowlake.sinks import append_dedup, delete_insert, merge, write_table
from flowlake.sinks.keyfilter import key_filter, unmatched

KEYS = ["day", "name", "id"]
SCHEMA = "day date, name string, id long, v long"


def rows(spark, ids, v, extra=()):
    data = [(dt.date(2024, 1, 1 + i % 28), f"n{i % 7}", i, v) for i in ids]
    return spark.createDataFrame(data + list(extra), SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.select("day", "name", "id", "v").collect()), key=repr)


def test_candidates_hold_all_matches_and_few_others(spark):
    target, batch = rows(spark, range(20000), 0), rows(spark, range(5000, 7000), 1)
    near = key_filter(batch, KEYS)
    found = near.candidates(target)
    wanted = target.join(batch, KEYS, "left_semi").count()
    assert wanted == 2000
    assert found.join(batch, KEYS, "left_semi").count() == wanted
    wide = key_filter(rows(spark, list(range(0, 20000, 10)), 1), KEYS)     # its ranges leave nothing out
    assert 2000 <= wide.candidates(target).count() <= 2000 + 18000 * 0.05
    assert near.others(target).count() + found.count() == 20000


@pytest.mark.parametrize("limit", [0, 10**6])
def test_unmatched_equals_anti_join(spark, limit, monkeypatch):
    monkeypatch.setattr("flowlake.sinks.keyfilter.key_filter",
                        lambda b, k: key_filter(b, k, max_keys=limit))
    nulls = [(None, "n1", 3, 0), (dt.date(2024, 1, 4), None, 3, 0), (dt.date(2024, 1, 4), "n3", None, 0)]
    target = rows(spark, [*range(100), 5, 5], 0, nulls)
    batch = rows(spark, [*range(3, 40, 3), 3, 250], 1, nulls)
    assert content(unmatched(target, batch, KEYS, True)) == content(unmatched(target, batch, KEYS, False))


def test_empty_sides(spark):
    some, none = rows(spark, range(5), 0), rows(spark, [], 0)
    only_null = rows(spark, [], 0, [(None, None, None, 1)])
    for batch in (none, only_null):
        assert key_filter(batch, KEYS).candidates(some).count() == 0
        assert content(unmatched(some, batch, KEYS, True)) == content(some)
    assert unmatched(none, some, KEYS, True).count() == 0


def test_signed_zero_and_nan_keys_match_like_the_join(spark):
    batch = spark.createDataFrame([(0.0,), (float("nan"),)], "k double")
    target = spark.createDataFrame([(-0.0,), (float("nan"),), (1.0,)], "k double")
    left = unmatched(target, batch, ["k"], True).collect()
    assert [r["k"] for r in left] == [1.0]


def test_ranges_reach_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    target = write_table(spark, rows(spark, range(1000), 0), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = key_filter(rows(spark, range(40, 60), 1), KEYS).candidates(target)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan[plan.index("== Physical Plan =="):].splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(id,40)" in scan and "LessThanOrEqual(id,59)" in scan


@pytest.mark.parametrize("write", [delete_insert, merge, append_dedup])
@pytest.mark.parametrize("parts", [None, ["day"]])
def test_writers_give_the_same_rows(spark, tmp_dir, write, parts):
    out = []
    for filtered in (False, True):
        path = os.path.join(tmp_dir, f"t{filtered}")
        write_table(spark, rows(spark, range(300), 0), path, parts)
        done = write(spark, rows(spark, range(290, 320), 1), path, KEYS, parts, filter_keys=filtered)
        out.append(content(done))
    assert out[0] == out[1] and len(out[0]) == 320
    assert sum(r[3] for r in out[0]) == (20 if write is append_dedup else 30)
    assert not [f for f in os.listdir(tmp_dir) if f.startswith("_")]


def test_filtered_delete_insert_respects_the_predicate(spark, tmp_dir):
    out = []
    for filtered in (False, True):
        path = os.path.join(tmp_dir, f"p{filtered}")
        write_table(spark, rows(spark, range(60), 0), path)
        out.append(content(delete_insert(spark, rows(spark, range(40, 80), 1), path, KEYS,
                                         predicate=F.col("id") >= 50, filter_keys=filtered)))
    assert out[0] == out[1] and len(out[0]) == 60 + 40 - 10
