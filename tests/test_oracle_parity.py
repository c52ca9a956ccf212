"""Every registered query with an oracle equals its DuckDB SQL on the test tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_util import canonical, duck

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canonical(cols, rows) == canonical(dcols, drows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "period" in df.columns and "blockchain" in df.columns
