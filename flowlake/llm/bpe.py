"""Byte-level BPE by speculation: propose greedily, verify pairs, merge only failures.

A text is cut into pre-token pieces.  Every distinct piece is encoded once per
task and remembered:

1. *Speculate*: the longest vocabulary entry at each position proposes tokens.
2. *Verify*: a token sequence is the BPE result exactly when each adjacent pair
   would survive on its own, i.e. no merge across the seam has a lower rank
   than the merges that built its two sides.  All distinct pairs of a batch are
   tested together in numpy, undoing one merge of a side per round.
3. *Repair*: only pieces with an incompatible pair run the exact merge loop
   (a heap over adjacent pairs, O(n log n) for one very long piece).

Decoding concatenates the bytes of the ids and reads them as UTF-8 with
replacement.

Defined cases: null and empty text give no ids and decode to the empty text; a
special token's string inside a text becomes its id; repeated rows are encoded
alike; columns other than the named ones are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from flowlake.llm.common import chunk_rows, released, text_buffer

# The public byte-level pre-token pattern.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

REMEMBERED_PIECES = 400_000   # pieces kept per task before the memory starts anew


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character → byte, as byte-level vocabularies spell bytes."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, ranks of merges and the pair a token was merged from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.id_of = {self.bytes_of[i]: i for i in vocab.values()}
        self.longest = max(map(len, self.id_of))
        # a merge is (left, right) → (rank, merged); made_from: how a token came to be
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)     # -1: a single byte
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            if pair not in self.merge:
                self.merge[pair] = (r, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, *pair
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.size, self._keys = size, keys[order]
        self._ranks = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._closed = self._self_encoding()

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging stops with exactly (a, b) on the bytes of a then b.

        Time runs backwards: the side whose last merge is the later one is
        undone first.  A merge across the seam of the two parts then standing
        wins if its rank is below that of the merge just undone (on equal rank
        the leftmost place goes first).
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)     # seam merges below it win
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            bad = self.pair_rank(x, y) < limit[live]
            good[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = bad | ((rx < 0) & (ry < 0))
            live, x, y, rx, ry = (v[~done] for v in (live, x, y, rx, ry))
            # equal ranks: the left side's merge happened first, so undo the right
            undo_left = rx > ry
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            # the seam lies right of a left-side merge and left of a right-side one
            limit[live] = np.where(undo_left, rx, ry + 1)
        return good

    def _self_encoding(self) -> np.ndarray:
        """Tokens that merging reaches from their own bytes (all bytes are)."""
        ok = np.ones(self.size, bool)
        made = np.flatnonzero(self.rank >= 0)
        ok[made] = False
        for i in made[np.argsort(self.rank[made], kind="stable")]:
            ok[i] = self.exact(self.bytes_of[i]) == [i] if len(self.bytes_of[i]) <= 64 else False
        return ok

    def greedy(self, piece: bytes) -> list[int]:
        whole = self.id_of.get(piece)
        if whole is not None and self._closed[whole]:
            return [whole]
        ids, i, n, longest, id_of = [], 0, len(piece), self.longest, self.id_of
        while i < n:
            j = min(n, i + longest)
            while True:
                token = id_of.get(piece[i:j])
                if token is not None:
                    break
                j -= 1
            ids.append(token)
            i = j
        return ids

    def exact(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost on ties: the defining merge loop."""
        ids = [self.id_of[piece[i:i + 1]] for i in range(len(piece))]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merge = self.merge
        heap = []
        for i in range(n - 1):
            found = merge.get((ids[i], ids[i + 1]))
            if found:
                heap.append((found[0], i, found[1], ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, made, x, y = heapq.heappop(heap)
            j = after[i] if ids[i] == x else n
            if j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merge.get((made, ids[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, found[1], made, ids[k]))
            h = before[i]
            if h >= 0:
                found = merge.get((ids[h], made))
                if found:
                    heapq.heappush(heap, (found[0], h, found[1], ids[h], made))
        return [i for i in ids if i >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        proposed = [self.greedy(p) for p in pieces]
        many = [i for i, ids in enumerate(proposed) if len(ids) > 1]
        if not many:
            return proposed
        flat = np.fromiter((t for i in many for t in proposed[i]), np.int64)
        owner = np.repeat(np.array(many), [len(proposed[i]) for i in many])
        inside = owner[1:] == owner[:-1]
        key = flat[:-1][inside] * self.size + flat[1:][inside]
        pairs, back = np.unique(key, return_inverse=True)
        a, b = pairs // self.size, pairs % self.size
        fits = self.compatible(a, b) & self._closed[a] & self._closed[b]
        for i in np.unique(owner[1:][inside][~fits[back]]):
            proposed[i] = self.exact(pieces[i])
        return proposed

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, concatenated (not yet read as UTF-8)."""
        return _ragged(self.flat, self.offset, ids).tobytes()


def _ragged(flat: np.ndarray, offset: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """flat[offset[i]:offset[i+1]] for each i of pick, concatenated."""
    length = offset[pick + 1] - offset[pick]
    total = np.cumsum(length)
    if not len(total) or total[-1] == 0:
        return flat[:0]
    shift = np.repeat(offset[pick] - (total - length), length)
    return flat[np.arange(total[-1]) + shift]


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary_of(path: str) -> Vocabulary:
    """One per worker process: tasks that follow each other share it."""
    if path not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


class Encoder:
    """Whole-text encoding with a memory of the pieces seen by this task."""

    def __init__(self, path: str):
        self.vocab = vocabulary_of(path)
        self.find = regex.compile(PIECES).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")") \
            if self.vocab.special else None
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.offset = np.zeros(1, np.int64)
        for token, i in self.vocab.special.items():   # a special token is a piece of its own
            self._remember([token], [[i]])

    def _remember(self, pieces: list[str], ids: list[list[int]]) -> None:
        for p in pieces:
            self.place[p] = len(self.place)
        self.ids = np.concatenate([self.ids, np.fromiter((t for x in ids for t in x), np.int32)])
        ends = self.offset[-1] + np.cumsum([len(x) for x in ids], dtype=np.int64)
        self.offset = np.concatenate([self.offset, ends])

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.vocab.special):
            return self.find(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                out.append(part)
            else:
                # a piece that merely looks like a special token cannot occur here
                out += self.find(part)
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) for t in texts]
        if len(self.place) > REMEMBERED_PIECES:
            self._forget()
        place = self.place
        new = list({p for c in cut for p in c if p not in place})
        if new:
            self._remember(new, self.vocab.encode_pieces([p.encode() for p in new]))
        return [_ragged(self.ids, self.offset, np.fromiter(map(place.__getitem__, c), np.int64, len(c)))
                for c in cut]


BATCH_BYTES = 500_000         # of text whose pieces are held at once, unless one text is longer


SCHEMA = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                     text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text of ``docs`` (narrow: no shuffle).

    Returns doc_id, n_tokens, ids_sha256 (of little-endian uint32 ids),
    decoded_sha256 (UTF-8 of the decoded text) and, with ``keep_ids``, the ids
    and the decoded text themselves.  ``vocabulary`` is a file that every
    worker can read at that path.
    """
    schema = SCHEMA + (", ids array<int>, decoded string" if keep_ids else "")
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            column = batch.column("text")
            for lo, hi in chunk_rows(text_buffer(column)[1], BATCH_BYTES):
                ids = encoder.encode_batch([t or "" for t in column.slice(lo, hi - lo).to_pylist()])
                decoded = [encoder.vocab.decode(x).decode("utf-8", "replace") for x in ids]
                columns = [batch.column("doc_id").slice(lo, hi - lo),
                           pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                           pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns += [pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
                                pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(released(run), schema)
