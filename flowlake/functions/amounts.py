"""Signed-flow and scaling expressions.

Raw token amounts are integers (uint256 in the source); they are carried as
DECIMAL(38,0) and summed exactly. Conversion to a human amount
(``raw / 10^decimals``) happens once, after the sum, as a DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlake.functions.address import ZERO_ADDRESS

U256 = "decimal(38,0)"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def raw_units(col) -> Column:
    """Cast a raw integer amount to DECIMAL(38,0); overflow raises under ANSI."""
    return _c(col).cast(U256)


def touches_zero(from_col="from", to_col="to", zero: str = ZERO_ADDRESS) -> Column:
    """``zero IN (from, to)`` — the mint/burn row filter."""
    return (_c(from_col) == F.lit(zero)) | (_c(to_col) == F.lit(zero))


def signed_by_zero_address(value, from_col="from", to_col="to",
                           zero: str = ZERO_ADDRESS) -> Column:
    """from = zero → +value, to = zero → −value, otherwise NULL.

    Arm order matters: a zero→zero row counts as a mint.
    """
    v = _c(value)
    return (F.when(_c(from_col) == F.lit(zero), v)
            .when(_c(to_col) == F.lit(zero), -v))


def action_sign_value(value, action_col="action", mint: str = "mint",
                      burn: str = "burn") -> Column:
    """action = mint → +value, burn → −value, any other action → NULL."""
    v = _c(value)
    return F.when(_c(action_col) == mint, v).when(_c(action_col) == burn, -v)


def scale_down(col, decimals) -> Column:
    """``value / 10^decimals`` as DOUBLE; ``decimals`` is an int or a column."""
    d = F.lit(decimals) if isinstance(decimals, int) else _c(decimals)
    return _c(col).cast("double") / F.pow(F.lit(10.0), d)
