"""256-bit integers against Python integers."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowlake.functions import wide

EDGES = [0, 1, -1, 10**26 - 1, 10**26, -10**26, 10**52 - 1, 10**52, (1 << 255) - 1, -(1 << 255), (1 << 256) - 1, 10**78 - 1]


def numbers(seed, n=60):
    rnd = random.Random(seed)
    return EDGES + [rnd.choice([1, -1]) * rnd.getrandbits(rnd.randint(1, 255)) for _ in range(n)]


def test_text_there_and_back(spark):
    values = numbers(1)
    texts = [str(v) for v in values] + ["+7", "-0", "000", " 42 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("w", wide.from_text("t"))
    df = df.withColumn("w", wide.normalized("w"))
    got = [tuple(r) for r in df.select("t", wide.to_text("w"), wide.to_double("w")).collect()]
    for t, shown, number in got:
        if t is None:
            assert shown is None and number is None
        else:
            assert int(shown) == int(t) and shown == str(int(t))
            assert number == pytest.approx(float(int(t)), rel=1e-14)


@pytest.mark.parametrize("text", ["", "1.5", "0x10", "1" * 79, "--1"])
def test_other_texts_raise(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(wide.from_text("t")["l0"])
    with pytest.raises(Exception, match="256 bits"):
        df.collect()


def test_int256_bounds(spark):
    def limbs(v):
        return spark.createDataFrame([(str(v),)], "t string").withColumn("w", wide.from_text("t"))
    for v, fits in [((1 << 255) - 1, True), (-(1 << 255), True), (1 << 255, False), (-(1 << 255) - 1, False), (0, True)]:
        df = limbs(v).withColumn("w", wide.normalized("w"))
        assert df.select(wide.fits_int256("w")).first()[0] is fits
        texts = spark.createDataFrame([(str(v),)], "t string").select(wide.from_text("t", int256=True)["l0"])
        if fits:
            texts.collect()
            assert df.withColumn("w", wide.checked_int256("w")).select(wide.to_text("w")).first()[0] == str(v)
        else:
            with pytest.raises(Exception, match="int256"):
                df.select(wide.checked_int256("w")["l0"]).collect()
            with pytest.raises(Exception, match="256 bits"):
                texts.collect()


def test_sums_near_the_top_in_any_partitioning(spark):
    values = [(k % 3, v) for k, v in enumerate(numbers(2, 200) * 3)]
    df = spark.createDataFrame([(k, str(v)) for k, v in values], "k int, t string").repartition(5)
    out = wide.wide_net_flow(df.withColumn("w", wide.from_text("t")), ["k"], "w").select("k", wide.to_text("net"))
    want = {k: str(sum(v for g, v in values if g == k)) for k in range(3)}
    assert dict(map(tuple, out.collect())) == want


def test_interest_and_small_decimals(spark):
    rows = [(str(10**60), 5, False), (str(10**60), 5, True), ("7", 10**37, False), (None, 1, True)]
    df = spark.createDataFrame([(v, Decimal(i), b) for v, i, b in rows], "v string, i decimal(38,0), burn boolean")
    df = df.withColumn("v", wide.from_text("v")).withColumn("i", wide.from_decimal("i"))
    df = wide.wide_column(df, "w", wide.interest_adjusted("v", "i", F.col("burn")), wide.normalized)
    assert [r[0] for r in df.select(wide.to_text("w")).collect()] == [str(10**60 - 5), str(-(10**60) - 5), str(7 - 10**37), None]


def test_binary_two_complement(spark):
    values = [v for v in numbers(3) if -(1 << 255) <= v < 1 << 255]
    rows = [(bytearray((v % (1 << 256)).to_bytes(32, "big")), str(v)) for v in values] + [(bytearray(b"\xff"), "255"), (None, None)]
    df = spark.createDataFrame(rows, "b binary, t string").withColumn("w", wide.from_binary("b"))
    assert all(r[0] == r[1] for r in df.select(wide.to_text("w"), "t").collect())
    top = spark.createDataFrame([(bytearray(b"\xff" * 32),)], "b binary").withColumn("w", wide.from_binary("b", signed=False))
    assert top.select(wide.to_text("w")).first()[0] == str((1 << 256) - 1)
