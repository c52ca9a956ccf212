"""Key filter of a batch: which target rows can share a key with it at all.

Built in one pass over the batch's keys and one small aggregation:

* the least and greatest value of every key column, as literals that reach the
  target's scan (row groups and partitions outside are not read);
* a Bloom filter of 64-bit words.  A key sets PROBES bits of one word, so the test
  is one hash look-up and one mask.  The number of words follows the number of
  keys (about WORD_BITS / KEYS_PER_WORD bits a key); the filter is a table of
  (word, bits) with at most one row per word.

The word table is broadcast for at most MAX_KEYS keys (a million words, some 40 MB
as a hash table).  A larger batch keeps the ranges only, and the join after it is
an ordinary shuffled one: the same rows, less saved.

A filter lets false candidates through, never loses a match, so an exact join
follows.  NULL keys match nothing: they are in no filter and no candidate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_BITS = 64
KEYS_PER_WORD = 4
PROBES = 4
MAX_KEYS = 4_000_000

RANGED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType)


def _word(keys: list[str], n_words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_words).cast("long"))


def _mask(keys: list[str]) -> Column:
    """PROBES bits of a word, from a second hash of the key."""
    h = F.xxhash64(F.lit("bits"), *keys)
    bits = [F.shiftright(h, 6 * p).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for p in range(PROBES)]
    return reduce(Column.bitwiseOR, (F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits))


@dataclass(frozen=True)
class KeyFilter:
    """``ranges``: key column -> (least, greatest); ``words`` is None for batches above the bound."""
    keys: list[str]
    n_keys: int
    ranges: dict[str, tuple]
    words: DataFrame | None
    n_words: int

    def in_range(self) -> Column:
        """Whether every key column lies within the batch's values (never NULL)."""
        if not self.n_keys:
            return F.lit(False)
        inside = [F.col(k).isNotNull() for k in self.keys]
        for k, (low, high) in self.ranges.items():
            inside += [F.col(k) >= F.lit(low), F.col(k) <= F.lit(high)]
        return F.coalesce(reduce(Column.__and__, inside), F.lit(False))

    def _pushed(self, target: DataFrame) -> DataFrame:
        """The range as plain conjuncts, the form that scans take."""
        if not self.n_keys:
            return target.filter(F.lit(False))
        for k in self.keys:
            target = target.filter(F.col(k).isNotNull())
        for k, (low, high) in self.ranges.items():
            target = target.filter((F.col(k) >= F.lit(low)) & (F.col(k) <= F.lit(high)))
        return target

    def _hit(self) -> Column:
        return (_word(self.keys, self.n_words) == F.col("_word")) & (
            F.col("_bits").bitwiseAND(_mask(self.keys)) == _mask(self.keys))

    def candidates(self, target: DataFrame) -> DataFrame:
        """Target rows that may share a key with the batch: all that do, and few others."""
        rows = self._pushed(target)
        return rows if self.words is None else rows.join(F.broadcast(self.words), self._hit(), "left_semi")

    def others(self, target: DataFrame) -> DataFrame:
        """The remaining target rows; none of them shares a key with the batch."""
        if self.words is None:
            return target.filter(~self.in_range())
        return target.join(F.broadcast(self.words), self.in_range() & self._hit(), "left_anti")


def key_filter(batch: DataFrame, keys: list[str], max_keys: int = MAX_KEYS) -> KeyFilter:
    """The filter of ``batch``, which is read twice (write it first if it is dear)."""
    complete = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    rows = batch.filter(complete).select(*keys)
    ranged = [f.name for f in rows.schema if isinstance(f.dataType, RANGED)]
    seen = rows.agg(F.count(F.lit(1)).alias("_n"), *(F.min(k).alias(f"_low_{k}") for k in ranged),
                    *(F.max(k).alias(f"_high_{k}") for k in ranged)).first()
    n = seen["_n"]
    ranges = {k: (seen[f"_low_{k}"], seen[f"_high_{k}"]) for k in ranged} if n else {}
    n_words = max(math.ceil(n / KEYS_PER_WORD), 1)
    words = None
    if n <= max_keys:
        words = rows.groupBy(_word(keys, n_words).alias("_word")).agg(F.bit_or(_mask(keys)).alias("_bits"))
    return KeyFilter(list(keys), n, ranges, words, n_words)


def unmatched(target: DataFrame, batch: DataFrame, keys: list[str], filtered: bool) -> DataFrame:
    """Target rows whose key is not in ``batch``.

    ``filtered``: only candidates go through the exact anti join; the other rows pass
    without a shuffle, at the price of a second scan of ``target``.
    """
    gone = batch.select(*keys)
    if not filtered:
        return target.join(gone, keys, "left_anti")
    near = key_filter(batch, keys)
    return near.others(target).unionByName(near.candidates(target).join(gone, keys, "left_anti"))
