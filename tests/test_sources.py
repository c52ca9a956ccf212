"""Seeds from CSV, address helpers and keys."""

import datetime as dt
import os

from pyspark.sql import functions as F

from flowlake.functions.address import binary_to_hex, canonical_address
from flowlake.functions.keys import NULL_MARKER, surrogate_key
from flowlake.sources.catalog import Catalog
from flowlake.sources.seeds import read_seed


def test_read_seed_csv_canonicalises_hex_and_keeps_base58(spark, tmp_dir):
    rwa = os.path.join(tmp_dir, "rwa.csv")
    with open(rwa, "w") as f:
        f.write("protocol,blockchain,token_address,token_name,token_decimals,start_date\n"
                "ondo,ethereum,0xABCdef0000000000000000000000000000000001,OUSG,18,2023-02-01\n")
    seed = read_seed(spark, rwa, "rwa_tokens")
    row = seed.df.collect()[0]
    assert seed.rows == 1
    assert row["token_address"] == "0xabcdef0000000000000000000000000000000001"
    assert row["start_date"] == dt.date(2023, 2, 1) and row["token_decimals"] == 18

    spl = os.path.join(tmp_dir, "spl.csv")
    with open(spl, "w") as f:
        f.write("protocol,mint_address,token_name,token_decimals,start_date\n"
                "ondo,A1KLoBrKBde8Ty9qtNQUtq3C2ortoC3u7twggz7sEto6,USDY,6,2023-10-01\n")
    row = read_seed(spark, spl, "spl_tokens").df.collect()[0]
    assert row["token_address"] == "A1KLoBrKBde8Ty9qtNQUtq3C2ortoC3u7twggz7sEto6"


def test_address_helpers(spark):
    df = spark.createDataFrame([(" 0xAbC ", bytearray(b"\x00\xab"))], "a string, b binary")
    row = df.select(canonical_address("a").alias("a"), binary_to_hex("b").alias("b")).collect()[0]
    assert row["a"] == "0xabc" and row["b"] == "0x00ab"


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a")], "x string, y string")
    keys = [r["k"] for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 2
    expected = df.select(F.md5(F.concat_ws("-", F.lit(NULL_MARKER), F.lit("a"))).alias("k")).first()["k"]
    assert keys[0] == expected


def test_catalog_aliases(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(p)
    cat = Catalog(spark, {"tokens_solana.transfers": p},
                  aliases={"tokens_solana.tether_solana_transfers": "tokens_solana.transfers"})
    assert cat.read("tokens_solana.tether_solana_transfers").count() == 3
    assert cat.has("tokens_solana.tether_solana_transfers") and not cat.has("x.y")


def test_cli_arguments():
    from flowlake.__main__ import parse_args
    a = parse_args(["--catalog", "c.json", "--seeds", "s", "--out", "o", "--as-of", "2024-05-04",
                    "--full-refresh", "--test"])
    assert a.as_of == dt.date(2024, 5, 4) and a.full_refresh and a.test and a.select == "all"
