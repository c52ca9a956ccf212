"""LM scoring by online logistic context mixing over bits, of running text and of spellings.

Tokens are words (A-Z folded) and one end per text.  ``wordbits`` codes the tokens
of running text: a token is a path of bits in a tree whose leaves are the most
frequent words, the end, and one mark for all other words.  The words' own counts
and the hashed contexts of the words before (one, two, and the class that the
text so far is most like) predict each bit; a gated logistic mixer learnt online
over the whole training text combines them, and an adaptive map refines the result.

After the mark comes the other word itself:

    P_t(word) = (1 - L) * sum_k g_k,t Q_k(word) + L * P(spelling),   L = D V / N
    Q_k(word) = (max(c_k - D, 0) + (MU + D V_k) q(word)) / (N_k + MU)

over the other words only, with one expert Q_k per class of training texts (the
most frequent values of a class column, and the rest), q the share of
max(c - D, 0), and gates g that follow Bayes' rule word by word within a text (the
class of a scored text is never read).  The spelling, its bytes and a closing
blank, is mixed bit by bit as well: six hashed contexts (the one to five bytes
before the bit within the word, and the whole prefix), a gate by bit place and
contexts seen, and a map (old estimate and byte so far); it learns from distinct
words, each predicted with its own contribution taken out, since it stands for
words not met before.  What a text has used so far refines all words once more:

    (max(times - D_OWN, 0) + (KAPPA + D_OWN * distinct) P_t(word)) / (t + KAPPA)

and likewise its end, which is never used before.  Every step is a distribution,
so the sum of logs is a text's log-probability, and -score * log2(10) / bytes its
bits per byte.

Plan.  One pass cuts texts to word numbers of a *block* (BLOCK_BYTES of text)
with the block's dictionary: only distinct words per block travel afterwards.
Dictionaries are summed by word (counts), the spelling model is summed over
distinct training words (tables of fixed size, added up slice by slice), each
distinct word is scored once, answers go back to their block, and the block's
texts are scored beside them.  A second pass over the training text learns the
mixer of running text.  Tables grow with the training text up to a bound; they,
the weights and the tree's words are the only data that reaches the driver.

Defined cases: null text is empty and has its end as only token; without any
training text N = V = 0, words have their spelling alone, the end has chance 1/2
and the base is log10((0 + 1) / 1) = 0 per token; a null class is in the rest; repeated rows are scored alike; very long words and
texts are scored whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm import wordbits
from flowlake.llm.common import chunk_rows, find_words, mix64, released, text_buffer, work_path, written

BLOCK_BYTES = 32 << 20
CONTEXTS = 6
SLOTS = 1 << 20                # per context
ORDERS = 5
STEP = 1024                    # log-odds are kept in such parts
SLICES = 32                    # parts in which tables are added up
TABLE_TASKS = 12               # tables built at once
WORD_BATCH = 4096
BATCH_BYTES = 1 << 17          # of spellings, unless one word is longer
GATES = 8 * (CONTEXTS + 1)
MAP_BINS = 24
RATE = 1.0
D = 0.75
MU = 1000.0
KAPPA = 100.0
D_OWN = 0.95
DRIFT = 0.01                   # share of the gates that returns to the classes' own shares
CLASSES = 7                    # experts besides the rest
PACKED = 500_000               # answers that a task packs at once
SLICE_BYTES = 16 << 20         # of all tasks' parts of one slice
LEARN_TOKENS = 10_000_000      # of running text that a task learns from, about
KNOWN_WORDS = 1 << 15          # whose chances are worked out at once
SCORE_TOKENS = 1 << 16         # scored at once, unless one text is longer
LN10 = float(np.log(10))


# ---------------------------------------------------------------- spelling bits

def spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, bit, slots, gate part) of all bits of the words and their closing blanks.

    slots: (bits, CONTEXTS) table places; the gate part is the bit's place.
    """
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(length) - length
    word = np.repeat(np.arange(len(words)), length)
    place = np.arange(len(data)) - start[word]
    codes = data.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        # context hashes of each byte; bytes before the word's start are 0
        before = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint64), codes[:len(codes) - k]]) if k <= len(codes) else 0, 0).astype(np.uint64)
                  for k in range(1, ORDERS + 1)]
        context, last = [], np.zeros(len(data), np.uint64)
        for b in before:
            last = last * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(7)
            context.append(last)
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(length.max(initial=1)), 0x100000001B3, np.uint64)]))
        term = codes * powers[place]
        total = np.concatenate([[np.uint64(0)], np.cumsum(term, dtype=np.uint64)])
        context.append(total[:-1] - total[start][word] + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        bits = np.unpackbits(data).reshape(-1, 8)
        node = np.ones((len(data), 8), np.uint64)
        for k in range(1, 8):
            node[:, k] = node[:, k - 1] * np.uint64(2) + bits[:, k - 1]
        slots = np.empty((CONTEXTS, len(data) * 8), np.int32).T
        step = node.astype(np.uint32) * np.uint32(0x9E3779B1)
        for k, c in enumerate(context):
            h = (mix64(c + np.uint64(k + 1) * np.uint64(0x165667B19E3779F9)) >> np.uint64(32)).astype(np.uint32)
            slots[:, k] = ((h[:, None] + step) >> np.uint32(33 - SLOTS.bit_length())).reshape(-1)
    gate = np.tile(np.arange(8, dtype=np.int32), len(data))
    return np.repeat(word, 8), bits.reshape(-1).astype(np.int8), slots, np.stack([gate, node.reshape(-1).astype(np.int32)])


def word_batches(words: list[bytes]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if i + 1 - lo >= WORD_BATCH or size >= BATCH_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(words):
        yield lo, len(words)


class Tables:
    """Counts of zeros and ones: an array (CONTEXTS, SLOTS, 2)."""

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = np.zeros((CONTEXTS, SLOTS, 2), np.uint32) if counts is None else counts
        self.odds: dict[bool, np.ndarray] = {}

    def add(self, words: list[bytes]) -> None:
        self.odds.clear()
        for lo, hi in word_batches(words):
            _, bit, slots, _ = spelling(words[lo:hi])
            for k in range(CONTEXTS):
                np.add.at(self.counts[k].reshape(-1), slots[:, k].astype(np.intp) * 2 + bit, np.uint32(1))

    def small(self) -> "Tables":
        """The same ratios in 16 bits: pairs that are too large are halved together."""
        return Tables(_halved(self.counts.astype(np.float64)))

    def inputs(self, slots: np.ndarray, bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(log-odds scaled by confidence, number of seen contexts); ``bit`` is taken out if given."""
        x = np.empty(slots.shape[::-1], np.float32).T
        seen = np.zeros(len(slots), np.int32)
        odds = self._odds(bit is not None)
        for k in range(CONTEXTS):
            at = slots[:, k].astype(np.intp)      # numpy casts other index arrays in slow steps
            packed = odds[k][at if bit is None else at * 2 + bit]
            x[:, k] = (packed >> 1).astype(np.float32) * np.float32(1 / STEP)
            seen += packed & 1
        return x, seen

    def _odds(self, without: bool) -> np.ndarray:
        """By slot, or by slot and bit with one such bit taken out: the log-odds in parts of STEP, and whether it was seen."""
        if without not in self.odds:
            self.odds[without] = np.empty((CONTEXTS, SLOTS * (2 if without else 1)), np.int16)
            for k in range(CONTEXTS):
                for out in range(2 if without else 1):
                    n0, n1 = self.counts[k].astype(np.float32).T
                    if without:
                        n0, n1 = np.maximum(n0 - (1 - out), 0), np.maximum(n1 - out, 0)
                    n = n0 + n1
                    x = np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4))) * (n / (n + np.float32(0.5)))
                    self.odds[without][k, out::2 if without else 1] = np.rint(np.clip(x, -15, 15) * STEP).astype(np.int16) * 2 + (n > 0)
        return self.odds[without]


def _halved(counts: np.ndarray) -> np.ndarray:
    top = np.maximum(counts.max(axis=-1, keepdims=True) / 65535.0, 1.0)
    return np.rint(counts / 2 ** np.ceil(np.log2(top))).astype(np.uint16)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Mixer:
    """Gated weights and the adaptive probability map behind them."""

    def __init__(self):
        self.weights = np.full((GATES, CONTEXTS), 0.35, np.float64)
        self.uses = np.zeros(GATES)
        self.map_ones = np.zeros((256, MAP_BINS))
        self.map_all = np.zeros((256, MAP_BINS))

    @staticmethod
    def gate(place: np.ndarray, seen: np.ndarray) -> np.ndarray:
        return (place * (CONTEXTS + 1) + seen).astype(np.intp)

    @staticmethod
    def _bin(z: np.ndarray) -> np.ndarray:
        return np.clip((z + 9) * (MAP_BINS / 18), 0, MAP_BINS - 1).astype(np.int64)

    def _mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        weights = np.ascontiguousarray(self.weights.T, np.float32)
        return sum(x[:, k] * weights[k][gate] for k in range(CONTEXTS))

    def learn(self, tables: Tables, words: list[bytes]) -> None:
        for step, (lo, hi) in enumerate(word_batches(words)):
            _, bit, slots, (place, node) = spelling(words[lo:hi])
            x, seen = tables.inputs(slots, bit)
            gate = self.gate(place, seen)
            z = self._mixed(x, gate)
            p = _squash(z)
            key = node.astype(np.int64) * MAP_BINS + self._bin(z)
            self.map_all += np.bincount(key, minlength=256 * MAP_BINS).reshape(256, MAP_BINS)
            self.map_ones += np.bincount(key, weights=bit, minlength=256 * MAP_BINS).reshape(256, MAP_BINS)
            error = bit - p
            n = np.bincount(gate, minlength=GATES)
            rate = RATE / (1 + 0.02 * step)
            for k in range(CONTEXTS):
                slope = np.bincount(gate, weights=error * x[:, k], minlength=GATES)
                self.weights[:, k] += rate * slope / np.maximum(n, 32)
            self.uses += n

    def log10(self, tables: Tables, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word's spelling."""
        share = ((self.map_ones + 0.5) / (self.map_all + 1)).reshape(-1)
        trust = (self.map_all / (self.map_all + 64) * 0.5).reshape(-1)
        out = np.zeros(len(words))
        for lo, hi in word_batches(words):
            word, bit, slots, (place, node) = spelling(words[lo:hi])
            x, seen = tables.inputs(slots, None)
            z = self._mixed(x, self.gate(place, seen))
            key = node.astype(np.int64) * MAP_BINS + self._bin(z)
            p = _squash(z)
            t = trust[key]
            p = np.clip((1 - t) * p + t * share[key], 1e-6, 1 - 1e-6)
            out[lo:hi] = np.bincount(word, weights=np.log10(np.where(bit == 1, p, 1 - p)), minlength=hi - lo)
        return out


# ---------------------------------------------------------------- Spark: texts to numbers

def _columns(classes: int) -> list[tuple[str, str, pa.DataType]]:
    return [("kind", "int", pa.int32()), ("block", "long", pa.int64()), ("doc_id", "long", pa.int64()),
            ("held_out", "boolean", pa.bool_()), ("ids", "binary", pa.binary()), ("n_bytes", "long", pa.int64()),
            ("at", "int", pa.int32()), ("h", "long", pa.int64()), ("word", "binary", pa.binary()),
            *((f"c{k}", "long", pa.int64()) for k in range(classes))]


def index_texts(docs: DataFrame, held_out: Column, number: Column, classes: int, id_col: str,
                text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts, dictionary) written to the shared folder.

    texts: block, doc_id, held_out, n_bytes, ids (byte planes of int32 word numbers of the block).
    dictionary: block, at (word number), h, word, c0.. (uses in training texts by class).
    ``number`` is the class of a row, 0 to ``classes`` - 1.
    """
    spark = docs.sparkSession
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out.alias("held_out"),
                         number.alias("class"), docs[text_col].alias("text"))
    layout = _columns(classes)
    sql = ", ".join(f"{name} {kind}" for name, kind, _ in layout)

    def index_rows(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(rows, t) if name not in columns else columns[name]
                                           if isinstance(columns[name], pa.Array) else pa.array(columns[name], t)
                                           for name, _, t in layout], [name for name, _, _ in layout])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        known, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        words, counts = [], np.zeros((0, classes), np.int64)

        def dictionary() -> Iterator[pa.RecordBatch]:
            hashes = np.empty(len(place), np.int64)
            hashes[place] = known.view(np.int64)
            for lo in range(0, len(words), 50_000):
                hi = min(lo + 50_000, len(words))
                yield index_rows(hi - lo, kind=np.ones(hi - lo, np.int32), block=np.full(hi - lo, block), at=np.arange(lo, hi, dtype=np.int32),
                                  h=hashes[lo:hi], word=words[lo:hi], **{f"c{k}": counts[lo:hi, k] for k in range(classes)})

        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            number_of = batch.column("class").to_numpy()
            for lo, hi in chunk_rows(offsets):
                found = find_words(data, offsets[lo:hi + 1])
                distinct, first, back = np.unique(found.hash, return_index=True, return_inverse=True)
                at = np.searchsorted(known, distinct)
                new = np.append(known, np.uint64(0))[at] != distinct
                new[at == len(known)] = True
                if new.any():
                    raw = found.data.tobytes().lower()
                    spans = zip(found.start[first[new]].tolist(), found.end[first[new]].tolist())
                    added = [raw[s:e] for s, e in spans]
                    known, place = np.insert(known, at[new], distinct[new]), np.insert(place, at[new], len(words) + np.arange(len(added)))
                    words += added
                    counts = np.concatenate([counts, np.zeros((len(added), classes), np.int64)])
                    at = np.searchsorted(known, distinct)
                ids = place[at][back].astype(np.int32) if len(back) else np.zeros(0, np.int32)
                training = np.repeat(~out[lo:hi], np.diff(found.bound))
                cell = ids.astype(np.int64) * classes + np.repeat(number_of[lo:hi], np.diff(found.bound))
                np.add.at(counts.reshape(-1), cell[training], 1)
                n = hi - lo
                cut = [planes(ids[a:b].astype("<i4")) for a, b in zip(found.bound[:-1], found.bound[1:])]
                yield index_rows(n, kind=np.zeros(n, np.int32), block=np.full(n, block), doc_id=batch.column("doc_id").slice(lo, n),
                                  held_out=out[lo:hi], ids=cut, n_bytes=np.diff(offsets[lo:hi + 1]))
                size += len(found.data)
                if size >= BLOCK_BYTES:
                    yield from dictionary()
                    block, size = block + 1, 0
                    known, place, words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], np.zeros((0, classes), np.int64)
        yield from dictionary()

    path = work_path(spark, "lm-index")
    source.mapInArrow(released(run), sql).write.partitionBy("kind").parquet(path)
    both = spark.read.schema(sql).parquet(path)
    return (both.filter("kind = 0").select("block", "doc_id", "held_out", "ids", "n_bytes"),
            both.filter("kind = 1").select("block", "at", "h", "word", *(f"c{k}" for k in range(classes))))


# ---------------------------------------------------------------- Spark: the model

def planes(x: np.ndarray) -> bytes:
    """The bytes of little-endian numbers, all lowest bytes first: small numbers compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes() if len(x) else b""


def from_planes(data: np.ndarray, dtype: str, n: int) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(-1, n).T).view(dtype).reshape(n) if n else np.zeros(0, dtype)


def fit_tables(words: DataFrame) -> Tables:
    """Bit counts over distinct training words: partial tables, added slice by slice."""
    cells = 2 * CONTEXTS * SLOTS // SLICES

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            tables.add(batch.column("word").to_pylist())
        for k, part in enumerate(tables.counts.reshape(SLICES, cells)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([planes(part.astype("<u4"))], pa.binary())], ["slice", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
                x = from_planes(np.frombuffer(part.as_buffer(), np.uint8), "<u4", cells).astype(np.float64)
                sums[k] = x + sums[k] if k in sums else x
        for k, x in sums.items():
            small = _halved(x.reshape(-1, 2)).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([small.astype("<u2").tobytes()], pa.binary())], ["slice", "part"])

    parts = words.select("word").repartition(TABLE_TASKS).mapInArrow(released(build), "slice int, part binary")
    rows = parts.repartition(SLICES, "slice").mapInArrow(released(add), "slice int, part binary").collect()
    both = np.zeros((SLICES, cells), np.uint16)
    for r in rows:
        both[r["slice"]] = np.frombuffer(r["part"], "<u2")
    return Tables(both.reshape(CONTEXTS, SLOTS, 2))


def fit_mixer(words: DataFrame, tables) -> Mixer:
    """Each task learns online over its words; weights are averaged by use, map counts added."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, own = Mixer(), Tables(tables.value)
        for batch in batches:
            mixer.learn(own, batch.column("word").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in
                                          (mixer.weights, mixer.uses, mixer.map_ones, mixer.map_all)], ["w", "uses", "ones", "every"])

    mixer = Mixer()
    total = np.zeros((GATES, CONTEXTS))
    for r in words.select("word").repartition(TABLE_TASKS).mapInArrow(released(learn), "w binary, uses binary, ones binary, every binary").collect():
        w, uses, ones, every = (np.frombuffer(r[c], "<f8") for c in ("w", "uses", "ones", "every"))
        total += w.reshape(GATES, CONTEXTS) * uses[:, None]
        mixer.uses += uses
        mixer.map_ones += ones.reshape(256, MAP_BINS)
        mixer.map_all += every.reshape(256, MAP_BINS)
    used = mixer.uses > 0
    mixer.weights[used] = total[used] / mixer.uses[used, None]
    return mixer


def fit_running(texts: DataFrame, tree, tokens: int) -> wordbits.Mixer:
    """The mixer of running text, learnt from the whole column ``text``; ``tokens``: how many there are, about."""
    bits, tasks = wordbits.table_bits(tokens), max(4, tokens // LEARN_TOKENS)
    # the parts of all tasks for one slice stay within SLICE_BYTES
    slices = 1 << max(5, int(np.ceil(np.log2(tasks * wordbits.CONTEXTS * (8 << bits) / SLICE_BYTES))))
    cells = wordbits.CONTEXTS * (2 << bits) // slices

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = wordbits.Mixer(bits)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunk_rows(offsets):
                for token, context in wordbits.learnable(find_words(data, offsets[lo:hi + 1]), tree.value):
                    mixer.learn(tree.value, token, context)
        if not mixer.steps:
            return
        for k, part in enumerate([*mixer.counts.reshape(slices, cells), mixer.state()]):
            part = planes(part.astype("<u4")) if k < slices else part.astype("<f8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.binary())], ["slice", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
                raw = np.frombuffer(part.as_buffer(), np.uint8)
                x = from_planes(raw, "<u4", cells).astype(np.int64) if k < slices else raw.view("<f8")
                sums[k] = x + sums[k] if k in sums else x
        for k, x in sums.items():
            x = wordbits.packed_odds(x.reshape(-1, 2)).astype("<i2") if k < slices else x
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["slice", "part"])

    parts = texts.select("text").coalesce(tasks).mapInArrow(released(learn), "slice int, part binary")
    mixer = wordbits.Mixer(bits).freeze()
    odds = mixer.odds.reshape(slices, -1)
    for r in parts.repartition(min(slices, 256), "slice").mapInArrow(released(add), "slice int, part binary").collect():
        if r["slice"] < slices:
            odds[r["slice"]] = np.frombuffer(r["part"], "<i2")
        else:
            mixer.merge([np.frombuffer(r["part"], "<f8")])
    return mixer


# ---------------------------------------------------------------- scoring

class Experts:
    """Class experts over known words, joined with spellings."""

    def __init__(self, uses: np.ndarray, kinds: np.ndarray, distinct: int, ends: int):
        """uses, kinds: training words and distinct ones by class; distinct: over all classes."""
        self.uses, self.kinds = uses.astype(float), kinds.astype(float)
        self.words, self.distinct, self.ends = float(uses.sum()), float(distinct), float(ends)
        self.spelled = D * distinct / self.words if self.words else 1.0
        self.end = ends / (self.words + ends) if ends else 0.5
        self.prior = self.uses / self.words if self.words else np.full(len(uses), 1 / len(uses))

    def known(self, counts: np.ndarray) -> np.ndarray:
        """Q_k of words by their counts (words, classes); 0 for words without a count."""
        total = counts.sum(1)
        q = np.maximum(total - D, 0) / max(self.words - D * self.distinct, 1e-9)
        q = (np.maximum(counts - D, 0) + (MU + D * self.kinds) * q[:, None]) / (self.uses + MU)
        return np.where(total[:, None] > 0, q, 0.0)

    def log10(self, ids: np.ndarray, known: np.ndarray, spelling: np.ndarray) -> float:
        """log10 probability of one text; known and spelling (log10) are by word number."""
        bound = np.array([0, len(ids)])
        p, _ = own_text(ids, self.steps(ids, known, spelling, bound), np.zeros(1), bound)
        return float(p.sum() / LN10 + len(ids) * np.log10(1 - self.end) + np.log10(self.end))

    def steps(self, ids: np.ndarray, known: np.ndarray, spelling: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """ln of the chance of each word of the runs bound[i]..bound[i+1], whatever was used before."""
        q = known[ids]
        heard = q[:, 0] > 0
        gains = np.where(heard[:, None], np.log(np.maximum(q, 1e-300)), 0.0)
        gate = np.vstack([np.zeros((1, q.shape[1])), np.cumsum(gains, axis=0)])
        gate = gate[:-1] - np.repeat(gate[bound[:-1]], np.diff(bound), axis=0) + np.log(np.maximum(self.prior, 1e-300))
        gate = np.exp(gate - gate.max(1, keepdims=True))
        gate = (1 - DRIFT) * gate / gate.sum(1, keepdims=True) + DRIFT * self.prior
        # a long odd word has a spelling far below the least double: its sum stays in logs
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log((1 - self.spelled) * (gate * q).sum(1)), np.log(self.spelled) + LN10 * spelling[ids])


def own_text(ids: np.ndarray, p: np.ndarray, ends: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln chances of words and ends, refined by what each text, bound[i]..bound[i+1], has used so far."""
    n, size = len(ids), np.diff(bound)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(n) - np.repeat(bound[:-1], size)
    key = row * (int(ids.max(initial=0)) + 1) + ids
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    used = np.empty(n)
    used[order] = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    met = np.concatenate([[0], np.cumsum(used == 0)])
    distinct = met[:-1] - np.repeat(met[bound[:-1]], size)
    p, again = np.log(KAPPA + D_OWN * distinct) + p, np.flatnonzero(used)
    p[again] = np.logaddexp(np.log(used[again] - D_OWN), p[again])
    p -= np.log(at + KAPPA)
    return p, ends + np.log(KAPPA + D_OWN * (met[bound[1:]] - met[bound[:-1]])) - np.log(size + KAPPA)


def _unpacked(data: np.ndarray, classes: int) -> tuple[np.ndarray, ...]:
    """(at, lp, symbol, short hash, counts by class) of one payload."""
    n = len(data) // (16 + 8 * classes)
    four = [from_planes(data[4 * n * k:4 * n * (k + 1)], t, n) for k, t in enumerate(("<i4", "<f4", "<i4", "<u4"))]
    counts = np.empty((n, classes), np.int64)
    for k in range(classes):
        counts[:, k] = from_planes(data[8 * n * (k + 2):8 * n * (k + 3)], "<i8", n)
    return *four, counts


def block_words(payloads: list[np.ndarray], classes: int, experts: Experts) -> tuple[np.ndarray, ...]:
    """(uses, chance by class, spelling, symbol, short hash) of a block's words by their number.

    The payloads are taken off the list one by one: counts by class are never there for all words at once.
    """
    n = sum(len(x) for x in payloads) // (16 + 8 * classes)
    uses, known, spelling = np.zeros(n, np.int64), np.zeros((n, classes)), np.zeros(n)
    symbol, short = np.zeros(n, np.int32), np.zeros(n, np.uint32)
    while payloads:
        at, lp, own_symbol, h, counts = _unpacked(payloads.pop(), classes)
        uses[at], spelling[at], symbol[at], short[at] = counts.sum(1), lp, own_symbol, h
        counts[own_symbol != wordbits.OTHER] = 0
        for lo in range(0, len(at), KNOWN_WORDS):
            known[at[lo:lo + KNOWN_WORDS]] = experts.known(counts[lo:lo + KNOWN_WORDS])
    return uses, known, spelling, symbol, short


SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "bits_per_byte double")
_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                     ("bits_per_byte", pa.float64())])


def _classes(docs: DataFrame, held_out: Column, class_col: str | None) -> tuple[Column, int]:
    """(class number of a row, number of classes): the CLASSES most frequent values, then the rest."""
    if class_col is None:
        return F.lit(0), 1
    value = docs[class_col].cast("string")
    top = (docs.filter(~held_out & value.isNotNull()).groupBy(value.alias("v")).count()
           .orderBy(F.desc("count"), "v").limit(CLASSES).collect())
    number = F.lit(len(top))
    for k, row in enumerate(top):
        number = F.when(value == row["v"], F.lit(k)).otherwise(number)
    return number, len(top) + 1


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                class_col: str | None = "lang") -> DataFrame:
    """One row per document with its base and model log10 probabilities.

    ``held_out`` says which rows teach nothing; ``class_col`` groups the others.
    """
    sc = docs.sparkSession.sparkContext
    number, classes = _classes(docs, held_out, class_col)
    texts, dictionary = index_texts(docs, held_out, number, classes, id_col, text_col)
    cs = [f"c{k}" for k in range(classes)]
    any_use = " + ".join(cs) + " > 0"
    words = written(dictionary.groupBy("h").agg(*(F.sum(c).alias(c) for c in cs), F.any_value("word").alias("word")), "lm-words")
    known = words.filter(any_use)
    sums = known.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cs), *(F.count_if(F.col(c) > 0).alias(f"v_{c}") for c in cs),
                     F.count("*").alias("v")).first()
    ends = texts.filter(~F.col("held_out")).count()
    total, distinct = sum(sums[c] for c in cs) + ends, sums["v"] + (ends > 0)

    # the most frequent words are coded in running text, the others as one mark and a word of theirs
    every = sum((F.col(c) for c in cs[1:]), F.col(cs[0]))
    top = known.filter(every >= wordbits.LEAST).select("h", *cs).orderBy(F.desc(every), "h").limit(wordbits.WORDS).collect()
    top_h, top_n = np.array([r["h"] for r in top], np.int64), np.array([[r[c] for c in cs] for r in top], np.int64).reshape(-1, classes)
    rest = np.array([sums[c] for c in cs]) - top_n.sum(0)
    experts = Experts(rest, np.array([sums[f"v_{c}"] for c in cs]) - (top_n > 0).sum(0), sums["v"] - len(top), ends)
    tree = sc.broadcast(wordbits.Tree(top_h, top_n, int(rest.sum()), ends))
    running = sc.broadcast(fit_running(docs.filter(~held_out).select(docs[text_col].alias("text")), tree, total))

    tables = fit_tables(known)
    shared = sc.broadcast(tables.counts)
    mixer = sc.broadcast(fit_mixer(known, shared))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tables(shared.value)
        for batch in batches:
            lp = mixer.value.log10(own, batch.column("word").to_pylist())
            h = batch.column("h").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("h"), *(batch.column(c) for c in cs), pa.array(lp.astype(np.float32)),
                                              pa.array(tree.value.symbols(h)), pa.array(wordbits.short(h).view(np.int32))],
                                             ["h", *cs, "lp", "symbol", "short"])

    scored = words.mapInArrow(released(spell), ", ".join(["h long", *(f"{c} long" for c in cs), "lp float, symbol int, short int"]))
    answers = dictionary.select("block", "at", "h").join(scored, "h").select("block", "at", *cs, "lp", "symbol", "short")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per block for up to PACKED answers: byte planes of at, lp, symbol, short hash and the counts."""
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            block = whole.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            block = block[order]
            columns = [*(whole.column(c).to_numpy()[order].astype(t) for c, t in (("at", "<i4"), ("lp", "<f4"), ("symbol", "<i4"), ("short", "<i4"))),
                       *(whole.column(c).to_numpy()[order].astype("<i8") for c in cs)]
            cut = np.flatnonzero(np.diff(block)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(block)]):
                payload = b"".join(planes(x[lo:hi]) for x in columns)
                yield pa.RecordBatch.from_arrays([pa.array([block[lo]], pa.int64()), pa.array([payload], pa.binary())], ["block", "answers"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED:
                yield from packed()
                held, size = [], 0
        if size:
            yield from packed()

    def empty(kind: str, name: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    rows = (answers.mapInArrow(released(pack), "block long, answers binary")
            .select("block", F.lit(0).alias("kind"), "answers", empty("long", "doc_id"), empty("boolean", "held_out"),
                    empty("binary", "ids"), empty("long", "n_bytes"))
            .union(texts.select("block", F.lit(1), empty("binary", "answers"), "doc_id", "held_out", "ids", "n_bytes")))
    dealt = rows.repartition("block").sortWithinPartitions("block", "kind")
    scale = np.log10(total + distinct + 1.0)
    end_base = np.log10(ends + 1.0) - scale

    def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
        lo = size = 0
        for i, n in enumerate(sizes):
            size += n
            if size >= SCORE_TOKENS:
                yield lo, i + 1
                lo, size = i + 1, 0
        if lo < len(sizes):
            yield lo, len(sizes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, base = None, [], None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(blocks)]):
                if lo == hi:
                    continue
                if blocks[lo] != block:
                    block, parts, base, q, spelling, symbol, short = blocks[lo], [], None, None, None, None, None
                if kinds[lo] == 0:
                    for payload in batch.column("answers").slice(lo, hi - lo):
                        parts.append(np.frombuffer(payload.as_buffer(), np.uint8))
                    continue
                if base is None:
                    c, q, spelling, symbol, short = block_words(parts, classes, experts)
                    base = np.log10(c + 1.0) - scale
                part = batch.slice(lo, hi - lo)
                sizes = [len(x.as_buffer()) // 4 for x in part.column("ids")]
                for a, b in groups(sizes):
                    raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in part.column("ids").slice(a, b - a)]
                    ids = np.concatenate([np.zeros(0, np.int32), *(from_planes(x, "<i4", n) for x, n in zip(raw, sizes[a:b]))]).astype(np.intp)
                    bound = np.concatenate([[0], np.cumsum(sizes[a:b])])
                    row = np.repeat(np.arange(b - a), np.diff(bound))
                    token, context, of = wordbits.sequence(tree.value, symbol[ids], short[ids], bound)
                    coded = LN10 * running.value.log10(tree.value, token, context)
                    p, ends_p = coded[token != wordbits.END], coded[token == wordbits.END]
                    other = symbol[ids] == wordbits.OTHER
                    p[other] += experts.steps(ids[other], q, spelling, np.concatenate([[0], np.cumsum(other)])[bound])
                    p, ends_p = own_text(ids, p, ends_p, bound)
                    value = (np.bincount(row, weights=p, minlength=b - a) + ends_p) / LN10
                    size = part.column("n_bytes").slice(a, b - a).to_numpy()
                    columns = [part.column("doc_id").slice(a, b - a), part.column("held_out").slice(a, b - a), np.diff(bound) + 1,
                               np.bincount(row[c[ids] > 0], minlength=b - a) + (ends > 0), np.full(b - a, total),
                               np.bincount(row, weights=base[ids], minlength=b - a) + end_base, value,
                               pa.array(-value * np.log2(10) / np.maximum(size, 1), mask=size == 0)]
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, _RESULT)], schema=_RESULT)

    return dealt.mapInArrow(released(score), SCHEMA)
