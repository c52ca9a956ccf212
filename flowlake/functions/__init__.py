"""Column-expression helpers (pure pyspark.sql.functions, JVM-side)."""

from flowlake.functions.address import ZERO_ADDRESS, canonical_address, binary_to_hex
from flowlake.functions.amounts import (
    action_sign_value, raw_units, scale_down, signed_by_zero_address, touches_zero,
)
from flowlake.functions.classify import ordered_like
from flowlake.functions.keys import surrogate_key

__all__ = [
    "ZERO_ADDRESS", "canonical_address", "binary_to_hex", "action_sign_value",
    "raw_units", "scale_down", "signed_by_zero_address", "touches_zero",
    "ordered_like", "surrogate_key",
]
