"""Helpers shared by the operators: tables, folds, Arrow text buffers, word hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  They are hashed
straight from the UTF-8 bytes of an Arrow batch, without a Python object per
word: every word is a difference of a running polynomial sum.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowlake.session import workspace_dir

CHUNK_BYTES = 1 << 20
ROWS_A_FILE = 100_000        # of small rows
SMALL_CHUNK = 1 << 18         # where the arrays of a chunk take over a hundred times its bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{workspace_dir(spark, 'llm')}-{name}-{uuid.uuid4().hex[:8]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, its partitions on the executors' disks: for small tables that are read a few times.

    Unlike ``written`` it makes no file per task; on a local store Hadoop starts a
    process for every file and folder that it makes, a copy of the JVM until it runs.
    """
    return df.persist(StorageLevel.DISK_ONLY)


def gathered(df: DataFrame, name: str) -> DataFrame:
    """``written``, for rows that may be few: they are counted first and go to files of ROWS_A_FILE, not to one per task."""
    once = kept(df)
    try:
        return written(once.coalesce(max(1, -(-once.count() // ROWS_A_FILE))), name)
    finally:
        once.unpersist()


def release_memory() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, releasing memory at its end: Spark keeps idle worker
    processes for later tasks, and what they hold adds to that of the busy ones."""
    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return to_the_end


def in_fold(doc_id: str, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod modulus = remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


# ---------------------------------------------------------------- Arrow text

def text_buffer(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type)
    buffers = arr.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunk_rows(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# ---------------------------------------------------------------- word hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: For words as runs of letters: every ASCII byte that is not a letter parts words.
NOT_LETTER = np.zeros(256, bool)
NOT_LETTER[:128] = True
NOT_LETTER[65:91] = NOT_LETTER[97:123] = False
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes() -> np.ndarray:
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    return mix64((lower + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


_CODES = _byte_codes()
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; kept up to CHUNK_BYTES as far as they were asked for, made anew for longer texts."""
    if n > CHUNK_BYTES + 1:
        return _powers_upto(n)
    if "up" not in _powers or len(_powers["up"]) < n:
        _powers["up"], _powers["down"] = _powers_upto(SMALL_CHUNK + 1 if n <= SMALL_CHUNK + 1 else CHUNK_BYTES + 1)
    return _powers["up"], _powers["down"]


def _powers_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for base in (_BASE, _BASE_INV):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps, out=steps))
    return out[0], out[1]


@dataclass
class Words:
    """Words of consecutive rows: spans into ``data`` and 64-bit hashes."""
    data: np.ndarray       # bytes of these rows
    start: np.ndarray      # word spans, byte offsets into data
    end: np.ndarray
    hash: np.ndarray       # uint64
    bound: np.ndarray      # word range of row i: bound[i]..bound[i+1]
    heads: list[np.ndarray] = field(default_factory=list)     # hashes of asked-for prefixes

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))


def find_words(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = _SPACE,
               prefixes: tuple[int, ...] = ()) -> Words:
    """Words of the rows data[offsets[i]:offsets[i+1]]; words never cross rows.

    ``blanks`` says which bytes part words.  ``prefixes`` asks for the hashes of
    the words' first so many bytes too (0 where a word is not longer).
    """
    base = int(offsets[0])
    data = data[base:int(offsets[-1])]
    offs = offsets - base
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n == 0:
        return Words(data, empty, empty, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64),
                     [np.zeros(0, np.uint64) for _ in prefixes])
    blank = blanks[data]
    edge = np.ones(n + 1, bool)            # a word may start at i / end before i
    edge[1:n] = blank[:-1]
    edge[offs] = True
    start = np.flatnonzero(edge[:n] & ~blank)
    edge[:n] = blank
    edge[offs] = True
    end = np.flatnonzero(edge[1:] & ~blank) + 1
    up, down = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * up[:n], out=total[1:])
        h = mix64((total[end] - total[start]) * down[start])
        heads = []
        for k in prefixes:
            at = np.minimum(start + k, n)
            head = mix64((total[at] - total[start]) * down[start] + np.uint64(k))
            heads.append(np.where(end - start > k, head, np.uint64(0)))
    return Words(data, start, end, h, np.searchsorted(start, offs), heads)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans (case kept); another seed gives other hashes."""
    with np.errstate(over="ignore"):
        codes = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
        up, down = _power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * up[:len(data)], out=total[1:])
        return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bound): the k-word shingles of each row, in order, repeats kept.

    A row of 1 to k-1 words has its whole word sequence as one shingle; a row
    without words has none.
    """
    count = np.diff(words.bound)
    shingles = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    bound = np.zeros(len(count) + 1, np.int64)
    np.cumsum(shingles, out=bound[1:])
    row = np.repeat(np.arange(len(count)), shingles)
    first = words.bound[:-1][row] + (np.arange(bound[-1]) - bound[:-1][row])
    take = np.minimum(count, k)[row]
    padded = np.concatenate([words.hash, np.zeros(k, np.uint64)])
    with np.errstate(over="ignore"):
        h = take.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for j in range(k):
            part = mix64(padded[first + j] + np.uint64(j + 1) * np.uint64(0xE7037ED1A0B428DB))
            h = h * _BASE + (part if j == 0 else np.where(take > j, part, np.uint64(0)))
        return mix64(h), bound
