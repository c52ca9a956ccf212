"""Surrogate keys built from several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands in for NULL before hashing, so that
# (NULL, 'a') and ('', 'a') get different keys.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str) -> Column:
    """md5 of the '-'-joined string forms, NULL replaced by a marker."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
