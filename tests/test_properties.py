"""Property checks against brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowlake.operators.pricing import price_lookup

SUB, SRC = "0xsub", "0xsrc"
TOKENS = [SUB, SRC, "0xa", "0xb"]
DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]

balance_rows = st.lists(st.tuples(st.sampled_from(["eth", "arb"]), st.sampled_from(DAYS),
                                  st.sampled_from(TOKENS)), min_size=1, max_size=12)
price_rows = st.lists(st.tuples(st.sampled_from(["eth", "arb"]), st.sampled_from(DAYS),
                                st.sampled_from(TOKENS), st.integers(1, 5).map(float)),
                      max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(balance_rows, price_rows)
def test_price_key_expansion_equals_or_join(spark, balances, prices):
    b = spark.createDataFrame(balances, "blockchain string, dt date, token_address string")
    p = spark.createDataFrame(prices, "blockchain string, dt date, token_address string, price_usd double")
    ours = sorted((tuple(r) for r in price_lookup(b, p, ["blockchain", "dt"], aliases={SUB: SRC})
                   .select("blockchain", "dt", "token_address", "price_usd").collect()), key=repr)
    cond = ((b.blockchain == p.blockchain) & (b.dt == p.dt)
            & (((b.token_address == SUB) & (p.token_address == SRC)) | (b.token_address == p.token_address)))
    ref = sorted((tuple(r) for r in b.join(p, cond, "left")
                  .select(b.blockchain, b.dt, b.token_address, p.price_usd).collect()), key=repr)
    assert ours == ref


ZERO = "0x" + "0" * 40
ADDR = st.sampled_from([ZERO, "0x1", "0x2", None])
transfer_rows = st.lists(st.tuples(st.sampled_from(DAYS), st.sampled_from(["0xa", "0xb"]), ADDR, ADDR,
                                   st.integers(0, 10 ** 20)), max_size=20)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(transfer_rows)
def test_zero_address_flow_matches_brute_force(spark, rows):
    from decimal import Decimal

    from flowlake.operators.flows import zero_address_flow

    df = spark.createDataFrame([(d, t, f, to, Decimal(v)) for d, t, f, to, v in rows],
                               "dt date, token_address string, from string, to string, value decimal(38,0)")
    got = {(r["dt"], r["token_address"]): r["amount"]
           for r in zero_address_flow(df, ["dt", "token_address"], 18).collect()}
    expected: dict = {}
    for d, t, f, to, v in rows:
        if f == ZERO:
            s = v
        elif to == ZERO:
            s = -v
        else:
            continue
        expected[(d, t)] = expected.get((d, t), 0) + s
    assert got == {k: float(v) / 1e18 for k, v in expected.items()}


event_rows = st.lists(st.tuples(st.integers(1, 6), st.integers(0, 3)), min_size=1, max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(event_rows, st.integers(2, 5), st.integers(0, 3))
def test_incremental_delete_insert_equals_full_rebuild(spark, tmp_dir, rows, cut, late_shift):
    """A first run up to day ``cut`` (late rows missing), then an incremental run
    whose lookback reaches every late row, equals a full rebuild."""
    import os
    import uuid

    from pyspark.sql import functions as F

    from flowlake.plans.blocks import PARTITION_BY, UNIQUE_KEY, tx_per_block
    from flowlake.sinks import delete_insert, write_table

    data = [(dt.date(2024, 1, d), d * 100 + h, i % 4 == 0) for i, (d, h) in enumerate(rows)]
    df = spark.createDataFrame(data, "block_date date, block_number long, late boolean")
    window = dt.date(2024, 1, max(1, cut - late_shift))
    first = df.filter((F.col("block_date") <= F.lit(dt.date(2024, 1, cut)))
                      & ~(F.col("late") & (F.col("block_date") >= F.lit(window))))
    run = os.path.join(tmp_dir, uuid.uuid4().hex)
    write_table(spark, tx_per_block(first), f"{run}/inc", PARTITION_BY)
    delete_insert(spark, tx_per_block(df, since=window), f"{run}/inc", UNIQUE_KEY, PARTITION_BY,
                  predicate=F.col("block_date") >= F.lit(window))
    full = write_table(spark, tx_per_block(df), f"{run}/full", PARTITION_BY)
    inc = spark.read.parquet(f"{run}/inc")
    cols = ["block_number", "block_date", "total_tx_per_block"]
    assert sorted(tuple(r) for r in inc.select(*cols).collect()) == \
        sorted(tuple(r) for r in full.select(*cols).collect())
