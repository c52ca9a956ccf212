"""Address canonicalisation.

EVM addresses are kept as canonical lower-case ``0x…`` strings: the
reference decodes hex text with ``from_hex`` (case-insensitive) and prints
varbinary as hex; under one canonical string form both are a ``lower``.
Base58 addresses (Solana) are case-sensitive and must never be lower-cased.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the EVM zero address used to recognise mints and burns.
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"


def canonical_address(col: Column | str) -> Column:
    """Hex text in any case → lower-case ``0x…`` text (``from_hex`` equivalent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c))


def binary_to_hex(col: Column | str) -> Column:
    """varbinary → ``0x`` + lower hex. ``cast(binary as string)`` would decode UTF-8."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), None).otherwise(F.concat(F.lit("0x"), F.lower(F.hex(c))))


def raw_name(col: str) -> str:
    """Where ``keep_raw`` leaves the stored form of an address column."""
    return f"_raw_{col}"


def canonical_token(df, col: str) -> Column:
    """A token column of any stored form as canonical text.

    varbinary and hex text in any case become lower-case ``0x…`` text; other
    text (base58) keeps its case.
    """
    if dict(df.dtypes).get(col) == "binary":
        return binary_to_hex(col)
    text = F.trim(F.col(col).cast("string"))
    return F.when(F.lower(text).startswith("0x"), F.lower(text)).otherwise(text)


def address_in(df, col: str, addresses: list[str]) -> Column:
    """``col`` is one of ``addresses`` (canonical text), on the stored column where it can be.

    A varbinary column is compared with binary literals and text that is known to
    be stored canonically with text literals: both reach the scan as pushed
    filters. Text in unknown case is compared after canonicalisation.
    """
    types = dict(df.dtypes)
    stored = raw_name(col) if raw_name(col) in types else col
    if types[stored] == "binary":
        whole = [bytes.fromhex(a[2:]) for a in addresses if re.fullmatch(r"0x([0-9a-fA-F]{2})*", a)]
        return F.col(stored).isin(*[F.lit(b) for b in whole]) if whole else F.lit(False)
    return F.col(stored if stored == col or types[stored] == "string" else col).isin(*addresses)


def address_text(df, col: str) -> Column:
    """An address column as text: hex for varbinary (never a UTF-8 cast), else as is."""
    if dict(df.dtypes).get(col) == "binary":
        return binary_to_hex(col)
    return F.col(col).cast("string")
