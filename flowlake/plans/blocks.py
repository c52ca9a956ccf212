"""Transactions per block – the model the materialization templates share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIQUE_KEY = ["block_number", "block_date"]
PARTITION_BY = ["block_date"]


def tx_per_block(transactions: DataFrame, since: dt.date | None = None) -> DataFrame:
    """block_number, block_date, total_tx_per_block (count per block).

    ``since``: the incremental window (a literal bound, pushed to the scan).
    """
    rows = transactions if since is None else transactions.filter(F.col("block_date") >= F.lit(since))
    return rows.groupBy("block_number", "block_date").agg(
        F.count(F.lit(1)).alias("total_tx_per_block"))
