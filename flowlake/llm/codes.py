"""Directly addressable codes: token ids split into byte chunks by level.

Every id gives its lowest 8 bits to level 0, the next 8 to level 1 and so on
while bits remain.  Each level is a byte array with one continuation bit per
entry; the ids that continue are packed, in order, in the next level, so the
place of an id there is the rank of its continuation bit.  A rank directory
(running popcount every 512 bits) makes that rank two table look-ups and one
popcount: any token is read without decoding its neighbours.

One file row is one segment::

    part, seq      writing partition (ascending doc_id) and place in it
    part_start     ids of the partition before this segment
    n_tokens       ids in the segment
    doc_ids, doc_lengths   documents of the segment and their id counts
    payload        b"DAC1", u8 levels, then per level: u32 n, n chunk bytes,
                   ceil(n/8) bitmap bytes (little bit first), u32 directory

Rows are written by Spark's committed Parquet writer into a folder that all
executors share, so a lost executor costs its unfinished tasks only.  Segments
close at about SEGMENT_TOKENS; a document is never split.

Defined cases: null and empty texts have only the end id; a null doc_id sorts
first; rows with the same doc_id are ordered by text; an empty table gives an
empty folder with the schema; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.common import chunk_rows, find_words, text_buffer

SEGMENT_TOKENS = 8192
RANK_BITS = 512
MAGIC = b"DAC1"
SEGMENT_SCHEMA = ("part int, seq int, part_start long, n_tokens long, doc_ids array<long>, "
                  "doc_lengths array<long>, payload binary")

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """The payload of one segment."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >= 256
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(bits), 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = _POP[bits]
        ranks = np.cumsum(padded.reshape(-1, 64).sum(1, dtype=np.uint32), dtype=np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), ranks[:-1]])
        levels.append(b"".join([struct.pack("<I", len(rest)), (rest & 255).astype(np.uint8).tobytes(),
                                bits.tobytes(), ranks.astype("<u4").tobytes()]))
        if not more.any():
            return MAGIC + bytes([len(levels)]) + b"".join(levels)
        rest = rest[more] >> 8


class Codes:
    """Reader of one payload: ``all()`` or random access by ``at(positions)``."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a directly-addressable-code segment")
        self.levels, at = [], 5
        for _ in range(payload[4]):
            (n,) = struct.unpack_from("<I", payload, at)
            chunk = np.frombuffer(payload, np.uint8, n, at + 4)
            at += 4 + n
            size = -(-n // 8)
            bits = np.frombuffer(payload, np.uint8, size, at)
            at += size
            blocks = -(-max(size, 1) // 64)
            ranks = np.frombuffer(payload, "<u4", blocks, at)
            at += 4 * blocks
            self.levels.append((chunk, bits, ranks))

    def all(self) -> np.ndarray:
        ids, live = None, None
        for k, (chunk, bits, _) in enumerate(self.levels):
            part = chunk.astype(np.uint32) << np.uint32(8 * k)
            if ids is None:
                ids, live = part, np.arange(len(chunk))
            else:
                ids[live] |= part
            live = live[np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)]
        return ids

    def at(self, positions: np.ndarray) -> np.ndarray:
        """Ids at these places of the segment, by rank look-ups alone."""
        at = np.asarray(positions, np.int64).copy()
        ids = np.zeros(len(at), np.uint32)
        live = np.arange(len(at))
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            ids[live] |= chunk[at].astype(np.uint32) << np.uint32(8 * k)
            go = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            live, at = live[go], at[go]
            if not len(live):
                break
            block = at // RANK_BITS
            inside = np.arange(RANK_BITS // 8)
            byte = block[:, None] * (RANK_BITS // 8) + inside
            seen = byte < (at >> 3)[:, None]
            count = np.where(seen, _POP[bits[np.minimum(byte, len(bits) - 1)]], 0).sum(1, dtype=np.int64)
            partial = bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
            at = ranks[block].astype(np.int64) + count + _POP[partial]
        return ids


class WordEncoder:
    """A library tokenizer with a memory of white-space-separated words.

    The tokenizer's normalizer and pre-tokenizer never join text across ASCII
    white space, so a text's ids are its words' ids in order.  A new word is
    cut by the library's own normalizer and pre-tokenizer (an ASCII word by the
    same pattern, directly; others many in a call) and its pieces go through the
    library's model.  Texts that may hold a special token's string are encoded whole.
    """

    WORDS = 1_000_000        # remembered (24 bytes each, and their ids) before the memory starts anew
    PIECES = 100_000
    TOGETHER = 512           # words cut by one call

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.ascii_pieces = re.compile(_ascii_pattern(json.load(f))).findall
        self.pieces: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        # words by hash (A-Z folded, as the normalizer lower-cases anyway), in order; place in offset
        self.hash, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.offset = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _cut(self, word: str) -> list[str]:
        """Pieces of one word, in the byte alphabet of the model."""
        word = self.library.normalizer.normalize_str(word)
        return [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(word)]

    def _cut_together(self, words: list[str]) -> list[list[str]]:
        """Pieces of words without white space of any kind: one library call for all of them.

        Line ends between the words become single spaces, which no piece crosses.
        """
        text = self.library.normalizer.normalize_str("\n".join(words))
        parts = text.split(" ")
        if len(parts) != len(words):
            return [self._cut(w) for w in words]
        ends = list(accumulate(len(p) + 1 for p in parts))
        out: list[list[str]] = [[] for _ in words]
        k = 0
        for piece, (start, _) in self.library.pre_tokenizer.pre_tokenize_str(text):
            while start >= ends[k]:
                k += 1
            out[k].append(piece)
        return out

    def _cut_all(self, words: list[str]) -> list[list[str]]:
        """Pieces of every word: ASCII words by the same pattern, others through the library."""
        out: list[list[str]] = [[]] * len(words)
        together = []
        for i, word in enumerate(words):
            if word.isascii() and word.isprintable():
                out[i] = self.ascii_pieces(word.lower())
            elif len(word.split()) == 1 and not word[0].isspace() and not word[-1].isspace():
                together.append(i)
            else:
                out[i] = self._cut(word)
        for lo in range(0, len(together), self.TOGETHER):
            places = together[lo:lo + self.TOGETHER]
            for i, pieces in zip(places, self._cut_together([words[i] for i in places])):
                out[i] = pieces
        return out

    def _remember(self, words: list[bytes], hashes: np.ndarray) -> None:
        known, model = self.pieces, self.library.model
        flat, lengths = [], []
        for pieces in self._cut_all([w.decode() for w in words]):
            n = len(flat)
            for piece in pieces:
                ids = known.get(piece)
                if ids is None:
                    if len(known) >= self.PIECES:
                        known.clear()
                    ids = known[piece] = [t.id for t in model.tokenize(piece)]
                flat += ids
            lengths.append(len(flat) - n)
        first = len(self.offset) - 1
        self.ids = np.concatenate([self.ids, np.array(flat, np.int32)])
        self.offset = np.concatenate([self.offset, self.offset[-1] + np.cumsum(lengths, dtype=np.int64)])
        at = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, at, hashes)
        self.place = np.insert(self.place, at, first + np.arange(len(words)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts data[offsets[i]:offsets[i + 1]]."""
        words = find_words(data, offsets)
        if len(self.hash) > self.WORDS:
            self._forget()
        distinct, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, distinct)
        new = np.append(self.hash, np.uint64(0))[at] != distinct
        new[at == len(self.hash)] = True
        raw = words.data.tobytes()
        if new.any():
            spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist())
            self._remember([raw[s:e] for s, e in spans], distinct[new])
            at = np.searchsorted(self.hash, distinct)
        pick = self.place[at][back] if len(back) else np.zeros(0, np.int64)
        length = self.offset[pick + 1] - self.offset[pick]
        total = np.concatenate([[0], np.cumsum(length)])
        flat = self.ids[np.arange(total[-1]) + np.repeat(self.offset[pick] - total[:-1], length)]
        cut = total[words.bound]
        out = [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]
        if b"<|" in raw:
            begin = (offsets - offsets[0]).tolist()
            for i, (a, b) in enumerate(zip(begin[:-1], begin[1:])):
                if b"<|" in raw[a:b]:
                    ids = self.library.encode(raw[a:b].decode(), add_special_tokens=False).ids
                    out[i] = np.array(ids, np.int32)
        return out


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder of this file: its memory of words (bounded) serves all tasks of the process."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _ascii_pattern(spec: dict) -> str:
    """The tokenizer's split pattern with its letter and number classes cut to ASCII."""
    (split,) = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
    if not split["invert"] or split["behavior"] != "Removed":
        raise ValueError("the pre-tokenizer must keep what its pattern matches")
    return split["pattern"]["Regex"].replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")


def write_codes(docs: DataFrame, tokenizer: str, end_id: int, path: str,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write segments in doc_id order.

    One shuffle: a range partitioning by doc_id.  ``tokenizer`` is a file that
    every worker can read at that path.
    """
    source = (docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
              .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names, ids, size = [], [], 0

        def close() -> pa.RecordBatch:
            lengths = [len(x) for x in ids]
            row = [[part], [seq], [before], [size], [list(names)], [lengths], [pack(np.concatenate(ids))]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)],
                ["part", "seq", "part_start", "n_tokens", "doc_ids", "doc_lengths", "payload"])

        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            for lo, hi in chunk_rows(offsets):
                for doc_id, x in zip(doc_ids[lo:hi], encoder.encode(data, offsets[lo:hi + 1])):
                    names.append(doc_id)
                    ids.append(np.append(x, end_id))
                    size += len(x) + 1
                    if size >= SEGMENT_TOKENS:
                        yield close()
                        seq, before = seq + 1, before + size
                        names, ids, size = [], [], 0
        if ids:
            yield close()

    source.mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> tuple[DataFrame, dict[int, int]]:
    """Segments and the number of ids before each writing partition.

    The dictionary has an entry per writing task, whatever the data.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sums = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    start, before = {}, 0
    for row in sorted(sums, key=lambda r: r["part"]):
        start[row["part"]] = before
        before += row["n"]
    return segments, start


def read_documents(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids_crc32 (and the ids)."""
    segments, part_start = read_segments(spark, path)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                ids = Codes(row["payload"]).all().astype("<u4")
                ends = np.cumsum(np.array(row["doc_lengths"], np.int64))
                starts = ends - np.array(row["doc_lengths"], np.int64)
                cut = [ids[a:b] for a, b in zip(starts, ends)]
                out = {"doc_id": pa.array(row["doc_ids"], pa.int64()),
                       "start": pa.array(starts + (part_start[row["part"]] + row["part_start"]), pa.int64()),
                       "n_tokens": pa.array(ends - starts, pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64())}
                if keep_ids:
                    out["ids"] = pa.array([x.astype(np.int64).tolist() for x in cut], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return segments.mapInArrow(run, schema)


def tokens_at(positions: DataFrame, path: str, column: str = "position") -> DataFrame:
    """Random access: the id at each global position (null outside the file).

    Positions are matched to segments through a coarse grid of SEGMENT_TOKENS
    ids (a segment covers a few cells), an equi join with a range residual.
    """
    spark = positions.sparkSession
    segments, part_start = read_segments(spark, path)
    starts = F.create_map(*[F.lit(x) for kv in part_start.items() for x in kv]) if part_start else None
    begin = (starts[F.col("part")] if starts is not None else F.lit(0)) + F.col("part_start")
    cells = (segments.withColumn("_begin", begin).withColumn("_end", F.col("_begin") + F.col("n_tokens"))
             .withColumn("_cell", F.explode(F.sequence((F.col("_begin") / SEGMENT_TOKENS).cast("long"),
                                                       ((F.col("_end") - 1) / SEGMENT_TOKENS).cast("long"))))
             .select("_cell", "_begin", "_end", "payload"))
    asked = positions.select(F.col(column).cast("long").alias("position"))
    asked = asked.withColumn("_cell", F.floor(F.col("position") / SEGMENT_TOKENS).cast("long"))
    joined = asked.join(cells, (asked["_cell"] == cells["_cell"]) & (asked["position"] >= cells["_begin"])
                        & (asked["position"] < cells["_end"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for p, b, payload in zip(*(batch.column(n).to_pylist() for n in ("position", "_begin", "payload"))):
                ids.append(None if payload is None else int(Codes(payload).at(np.array([p - b]))[0]))
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(ids, pa.int64())], ["position", "id"])

    return joined.select("position", "_begin", "payload").mapInArrow(run, "position long, id long")
