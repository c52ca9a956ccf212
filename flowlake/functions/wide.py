"""256-bit integers as three signed decimal limbs.

A uint256 has up to 78 digits and DECIMAL holds 38, so two limbs stop at 10^76,
below 2^255.  Three limbs of 26 digits hold every value:

    value = l2 * 10^52 + l1 * 10^26 + l0

Limbs are added and summed one by one, without looking at carries, so a sum is
three ordinary DECIMAL sums (partial, then final; exact in any order).  Each limb
has room for 10^12 addends; beyond, ANSI mode raises.  ``normalized`` carries:
l0 and l1 then lie in [0, 10^26) and l2 has the sign.

All functions take and give columns; NULL stays NULL.  Carrying reads a limb
several times, so give ``normalized`` and what follows it (``to_text``,
``to_double``, ``checked_int256``) a column that a ``withColumn`` before has made,
not an expression: Spark then evaluates it once.  ``wide_column`` does that.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 26
BASE = 10 ** DIGITS
LIMB = "decimal(38,0)"
MOST = 3 * DIGITS
INT256 = (-(1 << 255), (1 << 255) - 1)
NAMES = ("l0", "l1", "l2")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _struct(limbs: list[Column]) -> Column:
    return F.struct(*(x.cast(LIMB).alias(n) for n, x in zip(NAMES, limbs)))


def _limbs(wide) -> list[Column]:
    return [_c(wide)[n] for n in NAMES]


def _split(value: int) -> list[int]:
    """Limbs of a constant, as ``normalized`` would give them."""
    rest, out = value, []
    for _ in range(2):
        rest, limb = divmod(rest, BASE)
        out.append(limb)
    return [*out, rest]


def constant(value: int) -> Column:
    return _struct([F.lit(Decimal(x)) for x in _split(value)])


def from_text(col, int256: bool = False) -> Column:
    """Limbs of a decimal integer text (sign allowed); anything else raises.

    With ``int256`` so does a value outside of int256, told by its digits.
    """
    text = F.trim(_c(col))
    digits = F.regexp_replace(text, "^[+-]?0*", "")
    padded = F.lpad(digits, MOST, "0")
    negative = text.startswith("-")
    parts = [F.substring(padded, MOST - DIGITS * (k + 1) + 1, DIGITS).cast(LIMB) for k in range(3)]
    fits = text.rlike("^[+-]?[0-9]+$") & (F.length(digits) <= MOST)
    if int256:
        least, most = (str(abs(x)).rjust(MOST, "0") for x in INT256)
        fits = fits & (padded <= F.when(negative, F.lit(least)).otherwise(F.lit(most)))
    checked = F.when(fits, F.when(negative, _struct([-p for p in parts])).otherwise(_struct(parts))).otherwise(
        F.raise_error(F.concat(F.lit("not an integer of 256 bits: "), text)).cast(_type()))
    return F.when(text.isNotNull(), checked)


def _type() -> str:
    return "struct<" + ",".join(f"{n}:{LIMB}" for n in NAMES) + ">"


def from_decimal(col) -> Column:
    """Limbs of an integer that a DECIMAL(38,0) holds."""
    value, base = _c(col).cast(LIMB), F.lit(Decimal(BASE))
    low = (value % base).cast(LIMB)
    high = F.call_function("div", (value - low).cast(LIMB), base)
    return F.when(value.isNotNull(), _struct([low, high, F.lit(0)]))


def from_binary(col, signed: bool = True) -> Column:
    """Limbs of a big-endian integer of up to 32 bytes (two's complement if ``signed``).

    Eight 32-bit words are weighted with the limbs of their power of two: a word
    times a limb has at most 36 digits.
    """
    raw = F.hex(_c(col))
    text = F.lpad(raw, 64, "0")
    words = [F.conv(F.substring(text, 64 - 8 * (k + 1) + 1, 8), 16, 10).cast("decimal(10,0)") for k in range(8)]
    limbs = []
    for j in range(3):
        parts = [w * F.lit(Decimal(_split(1 << (32 * k))[j])).cast(f"decimal({DIGITS},0)") for k, w in enumerate(words)]
        total = parts[0].cast(LIMB)
        for p in parts[1:]:
            total = (total + p).cast(LIMB)
        limbs.append(total)
    value = _struct(limbs)
    if signed:
        high = F.length(raw) == 64
        negative = high & (words[7] >= F.lit(Decimal(1 << 31)))
        value = F.when(negative, subtract(value, constant(1 << 256))).otherwise(value)
    out = normalized(value)
    return F.when(_c(col).isNull(), F.lit(None)).when(F.length(raw) <= 64, out).otherwise(
        F.raise_error(F.lit("more than 32 bytes")).cast(_type()))


def _each(f, *wides) -> Column:
    return _struct([f(*limbs) for limbs in zip(*map(_limbs, wides))])


def add(a, b) -> Column:
    return _each(lambda x, y: x + y, a, b)


def subtract(a, b) -> Column:
    return _each(lambda x, y: x - y, a, b)


def negate(a) -> Column:
    return _each(lambda x: -x, a)


def signed(a, negative: Column) -> Column:
    return _each(lambda x: F.when(negative, -x).otherwise(x), a)


def sum_limbs(wide) -> Column:
    """Aggregate: limb sums, not yet carried."""
    return F.struct(*(F.sum(x).cast(LIMB).alias(n) for n, x in zip(NAMES, _limbs(wide))))


def normalized(wide) -> Column:
    base = F.lit(Decimal(BASE))
    l0, l1, l2 = _limbs(wide)

    def low_and_carry(x: Column) -> tuple[Column, Column]:
        low = F.pmod(x, base).cast(LIMB)
        return low, F.call_function("div", (x - low).cast(LIMB), base).cast(LIMB)      # exact: a multiple of the base

    r0, c0 = low_and_carry(l0)
    r1, c1 = low_and_carry((l1 + c0).cast(LIMB))
    return _struct([r0, r1, l2 + c1])


def sum_wide(wide) -> Column:
    return normalized(sum_limbs(wide))


def is_negative(normal) -> Column:
    return _c(normal)["l2"] < 0


def magnitude(normal) -> Column:
    return F.when(is_negative(normal), normalized(negate(normal))).otherwise(_c(normal))


def to_text(normal) -> Column:
    l0, l1, l2 = _limbs(magnitude(normal))
    digits = F.concat(l2.cast("string"), *(F.lpad(x.cast("string"), DIGITS, "0") for x in (l1, l0)))
    short = F.regexp_replace(digits, "^0+(?=[0-9])", "")
    return F.when(is_negative(normal), F.concat(F.lit("-"), short)).otherwise(short)


def to_double(normal) -> Column:
    """The nearest double but for the last bits; the sign is taken out first, so nothing cancels."""
    l0, l1, l2 = (x.cast("double") for x in _limbs(magnitude(normal)))
    value = l2 * F.lit(1e52) + l1 * F.lit(1e26) + l0
    return F.when(is_negative(normal), -value).otherwise(value)


def fits_int256(normal) -> Column:
    def key(w) -> Column:
        l0, l1, l2 = _limbs(w)
        return F.struct(l2.alias("l2"), l1.alias("l1"), l0.alias("l0"))

    low, high = (key(constant(x)) for x in INT256)
    return (key(normal) >= low) & (key(normal) <= high)


def checked_int256(normal) -> Column:
    """The value, or an error where it is no int256."""
    return F.when(_c(normal).isNull(), F.lit(None)).when(fits_int256(normal), _c(normal)).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("out of int256, limbs:"), *(x.cast("string") for x in reversed(_limbs(normal))))).cast(_type()))


def wide_column(df: DataFrame, name: str, *steps) -> DataFrame:
    """Column ``name`` made by ``steps``: a column, then functions of the column before."""
    first, *rest = steps
    df = df.withColumn(name, first)
    for f in rest:
        df = df.withColumn(name, f(name))
    return df


def interest_adjusted(value, increase, burn: Column) -> Column:
    """Signed supply change of a lending event without its accrued interest, exact."""
    return F.when(burn, negate(add(value, increase))).otherwise(subtract(value, increase))


def wide_net_flow(rows: DataFrame, keys: list[str], wide, out: str = "net") -> DataFrame:
    """Sum of signed 256-bit amounts per key: one partial and one final aggregation.

    The sum itself may be wider than 256 bits; ``checked_int256`` rejects that.
    """
    limbs = rows.select(*keys, _c(wide).alias("_w"))
    sums = limbs.groupBy(*keys).agg(*(F.sum(F.col("_w")[n]).cast(LIMB).alias(n) for n in NAMES))
    return sums.select(*keys, normalized(F.struct(*NAMES)).alias(out))
