"""Alignment of two tokenizers over the same bytes.

Tokenizer A is a byte-level vocabulary file, B a sentence-piece model that puts a
space before the text, so A encodes a space plus the text.  Token ends are byte
offsets.  The shorter end list of a document drives a galloping search in the
longer one: every end starts where its rank is expected, doubles its step until
it is passed, and halves the bracket.  Common ends cut both lists into groups.
The ranks of a driving token's two borders differ by the tokens of the other
side that it overlaps, so links need no second search.

    encoded(docs, a, b)    blocks of documents: their ids under both, packed
    groups(blocks)         one row per document with its groups
    pair_counts(...)       for an id pair, the documents that hold it linked, and
                           whether that is the highest count of its A id
    linked(blocks, ...)    one row per document: sizes, links and their counts

Blocks are written once to the shared folder and read by the later passes.  A
block sends each different pair once, whatever its documents, and gets one
answer back, so a pair that all documents hold is one row per block.  Blocks
hold about BLOCK_BYTES of text; a longer text is a block of its own.

Defined cases: a text that is null or empty, or whose tokens do not give a space
plus the text byte for byte (the model normalises some texts), has no tokens:
zeros and an empty string; special tokens' strings are plain text; rows with the
same or a null doc_id are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.bpe import byte_alphabet
from flowlake.llm.common import chunk_rows, span_hashes, text_buffer, written

BLOCK_BYTES = 1 << 20
BLOCK_SCHEMA = "block long, doc_id array<long>, n_a array<int>, n_b array<int>, a_ids binary, b_ids binary"


# ---------------------------------------------------------------- tokenizers

class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; special strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *special]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = special[i].encode() if i in special else bytes(alphabet[c] for c in token)
        for i, token in special.items():
            self.bytes_of[i] = token.encode()
        # the split pattern begins a piece at every single space between other characters
        self.by_words = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]


class Pieces:
    """A sentence-piece model with byte fallback; it puts a space before what it encodes."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        pieces = lib.id_to_piece(list(range(lib.vocab_size())))
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # no piece joins a space to a character before it, and spaces are kept as they are
        self.by_words = (not any("▁" in p.lstrip("▁") for p in pieces)
                         and "".join(lib.encode("a  b ", out_type=str)) == "▁a▁▁b▁")

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words that begin with a space, the one that the model adds."""
        return self.library.encode([w[1:] for w in words], num_threads=1)


_MAYBE_BLANK = np.zeros(256, bool)          # white space, or the first byte of a white-space character
_MAYBE_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Begins of the words of texts data[offsets[i]:offsets[i + 1]] that each begin with a space.

    A word begins with its text, or with a single space between two characters
    that are certainly no white space.  Neither tokenizer joins bytes across that
    place, so a text's ids are its words' ids.
    """
    n = len(data)
    maybe = _MAYBE_BLANK[data]
    begin = np.zeros(n, bool)
    if n > 4:
        clear = ~maybe
        begin[3:n - 1] = (data[3:n - 1] == 0x20) & clear[2:n - 2] & clear[1:n - 3] & clear[:n - 4] & clear[4:]
        # near a text's begin the bytes before belong to another text: two spaces there are no danger, as
        # the three bytes before a cut must be clear, which only leaves cuts out
    begin[offsets[:-1]] = True
    return np.flatnonzero(begin)


class Memory:
    """Ids of words under both tokenizers, remembered by the hash of their bytes.

    It is kept by the worker process for later tasks, up to MOST_WORDS words and
    MOST_IDS ids; then it starts anew.
    """

    MOST_WORDS = 1_200_000
    MOST_IDS = 8_000_000
    BATCH_BYTES = 1 << 16        # of new words through a library at once

    def __init__(self, sides: tuple[ByteLevel, Pieces]):
        self.sides = sides
        self.size = [np.array([len(x) for x in side.bytes_of], np.int64) for side in sides]
        self.spelt = [np.frombuffer(b"".join(side.bytes_of), np.uint8) for side in sides]
        self.by_words = all(side.by_words for side in sides)
        self._forget()

    def _forget(self) -> None:
        self.hash, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)                      # both sides give the word's bytes
        self.ids = [np.zeros(0, np.int32) for _ in self.sides]
        self.offset = [np.zeros(1, np.int64) for _ in self.sides]

    def _remember(self, words: list[bytes], hashes: np.ndarray) -> None:
        text = [w.decode() for w in words]
        whole = np.ones(len(words), bool)
        for s, side in enumerate(self.sides):
            flat, length, size, begin = [], [], 0, 0
            for k, w in enumerate(words):
                size += len(w)
                if size >= self.BATCH_BYTES or k + 1 == len(words):
                    ids = side.encode(text[begin:k + 1])
                    flat.append(np.array([i for x in ids for i in x], np.int32))
                    length += [len(x) for x in ids]
                    whole[begin:k + 1] &= self._gives(s, flat[-1], np.array(length[begin:]), words[begin:k + 1])
                    size, begin = 0, k + 1
            self.ids[s] = np.concatenate([self.ids[s], *flat])
            self.offset[s] = np.concatenate([self.offset[s], self.offset[s][-1] + np.cumsum(length, dtype=np.int64)])
        at = np.searchsorted(self.hash, hashes)
        self.place = np.insert(self.place, at, len(self.whole) + np.arange(len(words)))
        self.hash = np.insert(self.hash, at, hashes)
        self.whole = np.append(self.whole, whole)

    def _gives(self, s: int, ids: np.ndarray, counts: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Whether the tokens' bytes are the words' (words have at least one byte)."""
        size = self.size[s][ids]
        want = np.array([len(w) for w in words])
        same = np.bincount(np.repeat(np.arange(len(words)), counts), weights=size, minlength=len(words)) == want
        ids, size = ids[np.repeat(same, counts)], size[np.repeat(same, counts)]
        _, within = _spread(size)
        made = self.spelt[s][np.repeat((np.cumsum(self.size[s]) - self.size[s])[ids], size) + within]
        given = np.frombuffer(b"".join(words), np.uint8)[np.repeat(same, want)]
        begin = np.cumsum(want[same]) - want[same]
        if len(begin):
            same[np.flatnonzero(same)] = np.logical_and.reduceat(made == given, begin)
        return same

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids, number per text) of both sides; texts without tokens have none."""
        raw = [(" " + t).encode() if t else b"" for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        filled = np.flatnonzero(np.diff(offsets))
        begins = offsets[:-1][filled]
        start = cuts(data, np.append(begins, len(data))) if self.by_words else begins
        end = np.append(start[1:], len(data))[:len(start)]
        of = np.searchsorted(begins, start, side="right") - 1
        hashes = span_hashes(data, start, end)
        if len(self.hash) > self.MOST_WORDS or max(map(len, self.ids)) > self.MOST_IDS:
            self._forget()
        different, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, different)
        new = np.append(self.hash, np.uint64(0))[at] != different
        new |= at == len(self.hash)
        if new.any():
            self._remember([joined[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())], different[new])
            at = np.searchsorted(self.hash, different)
        pick = self.place[at][back] if len(back) else np.zeros(0, np.int64)
        good = np.ones(len(texts), bool)
        good[filled[of[~self.whole[pick]]]] = False
        pick = pick[good[filled[of]]]
        of = filled[of[good[filled[of]]]]
        ids, counts = [], []
        for flat, offset in zip(self.ids, self.offset):
            length = offset[pick + 1] - offset[pick]
            _, within = _spread(length)
            ids.append(flat[np.repeat(offset[pick], length) + within])
            counts.append(np.bincount(of, weights=length, minlength=len(texts)).astype(np.int64))
        return ids, counts


_memories: dict[tuple[str, str], Memory] = {}


def memory_of(a_path: str, b_path: str) -> Memory:
    """The worker process's encoders of these files."""
    if (a_path, b_path) not in _memories:
        _memories[a_path, b_path] = Memory((ByteLevel(a_path), Pieces(b_path)))
    return _memories[a_path, b_path]


# ---------------------------------------------------------------- alignment

def gallop(ends: np.ndarray, wanted: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each wanted value the number of ``ends`` below it (``ends`` ascending).

    Exponential steps from ``guess`` in the direction of the value, then binary
    search inside the bracket; all values move together.
    """
    n = len(ends)
    padded = np.append(ends, np.iinfo(np.int64).max)
    guess = np.clip(guess, 0, n)
    up = padded[guess] < wanted
    low, high = guess.copy(), guess.copy()        # answer in low..high
    step, live = 1, np.flatnonzero(up)
    low[live] += 1
    while len(live):
        high[live] = np.minimum(guess[live] + step, n)
        more = padded[high[live]] < wanted[live]
        live = live[more]
        low[live] = high[live] + 1
        step *= 2
    step, live = 1, np.flatnonzero(~up)
    while len(live):
        low[live] = np.maximum(guess[live] - step, 0)
        more = (low[live] > 0) & (padded[np.maximum(low[live] - 1, 0)] >= wanted[live])
        live = live[more]
        high[live] = low[live]
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) >> 1
        below = padded[mid] < wanted[live]
        low[live] = np.where(below, mid + 1, low[live])
        high[live] = np.where(below, high[live], mid)
        live = live[low[live] < high[live]]
    return low


@dataclass
class Links:
    """Alignment of consecutive documents; places count tokens from the first document's first."""
    n_groups: np.ndarray     # per document
    a_take: np.ndarray       # per group: tokens of each side
    b_take: np.ndarray
    n_links: np.ndarray      # per document
    a: np.ndarray            # per link: token places
    b: np.ndarray


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place in owner) of sum(counts) entries."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _pick(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray,
          take_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document the values of one of two flat lists; returns (values, their places in it)."""
    count = np.where(take_first, n_first, n_second)
    doc, k = _spread(count)
    from_first = take_first[doc]
    place = np.where(from_first, (np.cumsum(n_first) - n_first)[doc], (np.cumsum(n_second) - n_second)[doc]) + k
    values = np.empty(len(doc), np.int64)
    values[from_first] = first[place[from_first]]
    values[~from_first] = second[place[~from_first]]
    return values, place


def align_ends(a_len: np.ndarray, b_len: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Links:
    """Align documents of n_a[i] and n_b[i] tokens with these byte lengths.

    The two sides of a document have the same total length.
    """
    a_end, b_end = np.cumsum(a_len, dtype=np.int64), np.cumsum(b_len, dtype=np.int64)
    by_a = n_a <= n_b                                          # the shorter list drives
    wanted, place = _pick(a_end, b_end, n_a, n_b, by_a)
    longer, longer_place = _pick(a_end, b_end, n_a, n_b, ~by_a)
    n_short, n_long = np.minimum(n_a, n_b).astype(np.int64), np.maximum(n_a, n_b).astype(np.int64)
    doc, k = _spread(n_short)
    base = np.cumsum(n_long) - n_long
    guess = base[doc] + k * n_long[doc] // np.maximum(n_short[doc], 1)
    rank = gallop(longer, wanted, guess)
    common = longer[rank] == wanted if len(rank) else np.zeros(0, bool)
    # groups: tokens up to each common end, as differences
    g_doc = doc[common]
    first_of_doc = np.append(True, g_doc[1:] != g_doc[:-1])[:len(g_doc)]
    short_stop, long_stop = k[common] + 1, rank[common] + 1 - base[g_doc]

    def takes(stop: np.ndarray) -> np.ndarray:
        return stop - np.where(first_of_doc, 0, np.append(0, stop[:-1])[:len(stop)])

    short_take, long_take = takes(short_stop), takes(long_stop)
    # overlap ranges: from the token that begins at or holds the border before, to the one that holds the end
    before = np.append(0, (rank + common)[:-1])[:len(rank)]
    overlap = rank - before + 1
    driver, within = _spread(overlap)
    short_link, long_link = place[driver], longer_place[before[driver] + within]
    drives = by_a[doc[driver]] if len(driver) else np.zeros(0, bool)
    n_docs = len(n_a)
    return Links(np.bincount(g_doc, minlength=n_docs), np.where(by_a[g_doc], short_take, long_take),
                 np.where(by_a[g_doc], long_take, short_take), np.bincount(doc, weights=overlap, minlength=n_docs).astype(np.int64),
                 np.where(drives, short_link, long_link), np.where(drives, long_link, short_link))


def pack(values: np.ndarray) -> bytes:
    """Values from 0 as byte planes (lowest first), compressed: u8 planes, u32 values, data."""
    planes = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    raw = b"".join((values >> 8 * k & 0xFF).astype(np.uint8).tobytes() for k in range(planes))
    return struct.pack("<BI", planes, len(values)) + pa.compress(raw, "zstd", asbytes=True)


def unpack(payload: bytes) -> np.ndarray:
    planes, n = struct.unpack_from("<BI", payload)
    raw = np.frombuffer(pa.decompress(payload[5:], planes * n, "zstd"), np.uint8).reshape(planes, n)
    return sum((raw[k].astype(np.int64) << 8 * k for k in range(planes)), np.zeros(n, np.int64))


def encoded(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of documents (BLOCK_SCHEMA), written to the shared folder; no shuffle.

    Both tokenizer files lie at these paths on every worker.
    """
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memory_of(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunk_rows(offsets, BLOCK_BYTES):
                (a_ids, b_ids), (n_a, n_b) = memory.encode(batch.column("text").slice(lo, hi - lo).to_pylist())
                yield _row(BLOCK_SCHEMA, [number], [batch.column("doc_id").slice(lo, hi - lo)],
                           [n_a], [n_b], [pack(a_ids)], [pack(b_ids)])
                number += 1

    return written(source.mapInArrow(run, BLOCK_SCHEMA), "encoded")


def _arrow_type(name: str) -> pa.DataType:
    plain = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.list_(plain[name[6:-1]]) if name.startswith("array<") else plain[name]


def _row(schema: str, *columns) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = []
    for (_, kind), values in zip(fields, columns):
        t = _arrow_type(kind)
        if pa.types.is_list(t):
            (one,) = values
            flat = one.cast(t.value_type) if isinstance(one, pa.Array) else pa.array(np.asarray(one), t.value_type)
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        else:
            arrays.append(pa.array(values, t))
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


class Block:
    """One row of encoded()."""

    def __init__(self, table: pa.Table | pa.RecordBatch, k: int):
        def column(name: str) -> np.ndarray:
            return table.column(name)[k].values.to_numpy(zero_copy_only=False)

        self.number = table.column("block")[k].as_py()
        self.doc_id = table.column("doc_id")[k].values
        self.n_a, self.n_b = (column(n).astype(np.int64) for n in ("n_a", "n_b"))
        self.a_ids, self.b_ids = (unpack(table.column(n)[k].as_py()) for n in ("a_ids", "b_ids"))

    def links(self, a_size: np.ndarray, b_size: np.ndarray) -> tuple[Links, np.ndarray]:
        """Links in document order and the id pair of each as one number."""
        links = align_ends(a_size[self.a_ids], b_size[self.b_ids], self.n_a, self.n_b)
        return links, (self.a_ids[links.a] << 32) | self.b_ids[links.b]

    def texts(self, links: Links, strings: Strings) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document; empty without tokens."""
        a_take, b_take = links.a_take, links.b_take
        (a_group, a_in), (b_group, b_in) = _spread(a_take), _spread(b_take)
        codes = np.empty(len(self.a_ids) + len(self.b_ids), np.int64)
        before = np.cumsum(a_take + b_take) - a_take - b_take
        last_a, last_b = a_in == a_take[a_group] - 1, b_in == b_take[b_group] - 1
        codes[before[a_group] + a_in] = self.a_ids + np.where(last_a, strings.a_last, 0)
        codes[before[b_group] + a_take[b_group] + b_in] = self.b_ids + np.where(last_b, strings.b_last, strings.b)
        stop = np.cumsum(self.n_a + self.n_b).tolist()
        parts = strings.table
        return ["".join([parts[c] for c in codes[i:j].tolist()])[:-1] for i, j in zip([0, *stop[:-1]], stop)]


class Strings:
    """Ids with the sign that follows them."""

    def __init__(self, n_a: int, n_b: int):
        self.table = ([f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)]
                      + [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)])
        self.a_last, self.b, self.b_last = n_a, 2 * n_a, 2 * n_a + n_b


def groups(blocks: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups): the groups of every document as text, ``a1,a2|b1;a3|b2,b3``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = memory_of(a_path, b_path).size
        strings = Strings(*map(len, size))
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch, k)
                texts = block.texts(block.links(*size)[0], strings)
                yield pa.RecordBatch.from_arrays([block.doc_id, pa.array(texts, pa.string())], ["doc_id", "groups"])

    return blocks.mapInArrow(run, "doc_id long, groups string")


def block_pairs(blocks: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(block, a, b, n): the id pairs linked in a block and how many of its documents hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = memory_of(a_path, b_path).size
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch, k)
                links, pair = block.links(*size)
                stop = np.cumsum(links.n_links).tolist()
                held = [np.unique(pair[i:j]) for i, j in zip([0, *stop[:-1]], stop)]
                different, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(different), block.number)), pa.array((different >> 32).astype(np.int32)),
                     pa.array((different & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["block", "a", "b", "n"])

    return written(blocks.mapInArrow(run, "block long, a int, b int, n long"), "linked-pairs")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n_docs, best) over all documents; an A id has at most B's vocabulary of partners."""
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    return total.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def linked(blocks: DataFrame, pairs: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """One row per document: n_a, n_b, n_groups, n_links, n_best, count_sum and its groups.

    ``groups`` is the text of groups(); with ``digest`` it is ``groups_sha256``,
    empty without tokens.
    """
    answers = (pairs.select("block", "a", "b").join(pair_counts(pairs), ["a", "b"])
               .select("block", F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long")).alias("pair"),
                       "n_docs", "best"))
    last = "groups_sha256" if digest else "groups"
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    worker: dict = {}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not worker:
            worker["size"] = memory_of(a_path, b_path).size
            worker["strings"] = Strings(*map(len, worker["size"]))
        order = np.argsort(right.column("pair").to_numpy())
        known = right.column("pair").to_numpy()[order]
        n_docs, best = right.column("n_docs").to_numpy()[order], right.column("best").to_numpy()[order]
        out = []
        for k in range(left.num_rows):
            block = Block(left, k)
            links, pair = block.links(*worker["size"])
            at = np.searchsorted(known, pair)
            stop = np.cumsum(links.n_links)

            def per_doc(values: np.ndarray) -> np.ndarray:
                upto = np.append(0, np.cumsum(values, dtype=np.int64))
                return upto[stop] - upto[stop - links.n_links]

            texts = block.texts(links, worker["strings"])
            if digest:
                texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            values = [block.n_a, block.n_b, links.n_groups, links.n_links, per_doc(best[at]), per_doc(n_docs[at])]
            out.append(pa.Table.from_arrays([block.doc_id, *(pa.array(v, pa.int64()) for v in values), pa.array(texts, pa.string())],
                                            ["doc_id", *names, last]))
        return pa.concat_tables(out)

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + f", {last} string"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
