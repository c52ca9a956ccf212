"""Ordered pattern classifier: first matching LIKE arm wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_like(col, rules: list[tuple[str, str]], default: str | None,
                 lower: bool = True) -> Column:
    """CASE WHEN lower(col) LIKE p1 THEN l1 WHEN … ELSE default END."""
    c = F.col(col) if isinstance(col, str) else col
    if lower:
        c = F.lower(c)
    expr = None
    for pattern, label in rules:
        cond = c.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
