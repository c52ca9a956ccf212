"""Phrase collocations from stripes.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``.  Everything is counted per language.

A stripe belongs to a prefix of one to three words: an associative counter of
the words that follow it, with one more entry (END) for what is followed by no
possible extension.  Every task builds the stripes of a chunk of text, and they
are merged elementwise per prefix.  One merged stripe gives

- the extensions: entries of at least ``least`` occurrences are the phrases that
  are one word longer,
- the prefix total: the sum of all entries, END included,
- the subsumption maximum of the prefix; the mirrored maximum (a word before the
  phrase) comes from the same entries, keyed without their first word.

Stripes grow level by level: a phrase is counted only if its first and its last
words already are frequent phrases, which loses nothing.  What is frequent
travels as a bitmap of two hash bits per phrase, sized by their number up to
FILTER_BITS; a wrong or full bit costs rows, never a phrase.

The stripe of a frequent prefix would be one large group.  Prefixes with more
than a 1 / HOT_PREFIXES share of all words (at least SPLIT words) are listed,
so there are at most HOT_PREFIXES of them, and their stripes are merged in
segments by the next word, each of about that share.

Words are 64-bit hashes while they are counted.  All distinct words are checked
for equal hashes; if there are any, the count starts anew with another seed, so
the result is exact.

Defined cases: null text counts as empty, a null language is ``und``; a table
without phrases gives an empty result; ids are not read, so repeated rows count
again; very long texts are a chunk of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import chunk_rows, find_words, mix64, span_hashes, text_buffer, written

LONGEST = 4
CHUNK = 2 << 20
FILTER_BITS = 1 << 27
HOT_PREFIXES = 100_000
SPLIT = 1 << 14
SALTS = 16                   # copies of a single word's count where phrases look it up
WORDS = ["w1", "w2", "w3", "w4"]
UNKNOWN = "und"

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- words and phrase keys

class Tokens:
    """Words of some rows: hashes, languages and which neighbours share a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, seed: int):
        words = find_words(data, offsets, _APART)
        self.data = _LOWER[words.data]
        self.start, self.end = words.start, words.end
        h = words.hash if seed == 0 else span_hashes(self.data, words.start, words.end, seed)
        self.hash = np.where(h == 0, np.uint64(1), h)         # 0 is END
        row = words.row()
        self.lang = langs[row]
        breaks = np.cumsum(_BREAK[words.data])[words.start] if len(words.start) else np.zeros(0, np.int64)
        self.joined = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])

    def within(self, k: int) -> np.ndarray:
        """Places where k words in a row lie in one piece."""
        n = len(self.hash)
        ok = np.zeros(n, bool)
        if n >= k:
            ok[:n - k + 1] = True
            for j in range(k - 1):
                ok[:n - k + 1] &= self.joined[j:j + n - k + 1]
        return ok

    def keys(self, k: int, lang_hash: np.ndarray) -> np.ndarray:
        """Filter keys of the k words from each place (meaningful where within(k))."""
        n = len(self.hash)
        return phrase_keys(lang_hash[self.lang], [np.append(self.hash[j:], np.zeros(min(j, n), np.uint64)) for j in range(k)])


def phrase_keys(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = lang
        for w in words:
            key = mix64(key * np.uint64(0x9FB21C651E98DF25) + w)
        return key


def _hash_strings(values: list[str]) -> np.ndarray:
    raw = [v.encode() for v in values]
    offsets = np.cumsum([0, *map(len, raw)])
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets[:-1], offsets[1:])


def _rows(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Tokens, list[str], np.ndarray]]:
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        codes = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = _hash_strings(names)
        data, offsets = text_buffer(batch.column("text"))
        for lo, hi in chunk_rows(offsets, CHUNK):
            yield Tokens(data, offsets[lo:hi + 1], codes[lo:hi], seed), names, hashes


# ---------------------------------------------------------------- filters

class Filter:
    """Two bits per key in a bitmap of 64-bit words."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
        return [keys & np.uint64(bits - 1), (keys >> np.uint64(32)) & np.uint64(bits - 1)]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys, self.bits):
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def build_filter(phrases: DataFrame, k: int, count: int) -> Filter:
    """The bitmap of ``phrases`` (lang, w1..wk): at most FILTER_BITS / 64 rows reach the driver."""
    bits = 1 << 10
    while bits < 16 * count and bits < FILTER_BITS:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(Filter.places(_batch_keys(batch, k), bits))
            mask = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(mask)], ["slot", "mask"])

    found = (phrases.select("lang", *WORDS[:k]).mapInArrow(run, "slot long, mask long")
             .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())
    words = np.zeros(max(bits >> 6, 1), np.uint64)
    words[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return Filter(bits, words)


def _batch_keys(batch: pa.RecordBatch, k: int) -> np.ndarray:
    langs = batch.column("lang").dictionary_encode()
    hashes = _hash_strings(langs.dictionary.to_pylist())
    lang = hashes[langs.indices.to_numpy(zero_copy_only=False)] if batch.num_rows else np.zeros(0, np.uint64)
    return phrase_keys(lang, [batch.column(w).to_numpy().view(np.uint64) for w in WORDS[:k]])


class Hot:
    """Segments of the stripes of frequent prefixes; all other stripes have one."""

    def __init__(self, keys: np.ndarray, segments: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.segments = keys[order], segments[order]

    def segment(self, keys: np.ndarray, following: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        n = np.where(self.keys[at] == keys, self.segments[at], 1).astype(np.uint64)
        return (mix64(following) % n).astype(np.int64)


def find_hot(phrases: DataFrame, k: int, all_words: int) -> Hot:
    """Prefixes with more than a 1 / HOT_PREFIXES share of the words, at most HOT_PREFIXES of them."""
    share = max(SPLIT, all_words // HOT_PREFIXES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_batch_keys(batch, k).view(np.int64)), batch.column("f")], ["key", "f"])

    rows = phrases.filter(F.col("f") > share).select("lang", *WORDS[:k], "f").mapInArrow(run, "key long, f long").toArrow()
    return Hot(rows.column("key").to_numpy().view(np.uint64), -(-rows.column("f").to_numpy() // share))


# ---------------------------------------------------------------- stripes

def count_words(source: DataFrame, seed: int) -> DataFrame:
    """(lang, w1, word, f) of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, names, _ in _rows(batches, seed):
            raw = t.data.tobytes()
            for code in np.unique(t.lang).tolist():
                own = np.flatnonzero(t.lang == code)
                h, first, n = np.unique(t.hash[own], return_index=True, return_counts=True)
                spans = zip(t.start[own[first]].tolist(), t.end[own[first]].tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[code]] * len(h), pa.string()), pa.array(h.view(np.int64)),
                     pa.array([raw[s:e].decode() for s, e in spans], pa.string()), pa.array(n)], ["lang", "w1", "word", "n"])

    return (source.mapInArrow(run, "lang string, w1 long, word string, n long")
            .groupBy("lang", "w1", "word").agg(F.sum("n").alias("f")))


def chunk_stripes(t: Tokens, k: int, names: list[str], lang_hash: np.ndarray, frequent: Filter, hot: Hot) -> pa.RecordBatch:
    """Stripes of the (k - 1)-word prefixes of one chunk: a row per prefix and segment."""
    keys = t.keys(k - 1, lang_hash)
    prefix = t.within(k - 1)
    prefix[prefix] = frequent.holds(keys[prefix])
    whole = t.within(k)
    whole[:-1] &= prefix[:-1] & prefix[1:]
    at = np.flatnonzero(prefix)
    ends = np.append(t.hash, np.zeros(k, np.uint64))[at + k - 1]
    following = np.where(whole[at], ends, np.uint64(0))
    segment = hot.segment(keys[at], following)
    # dense numbers: word, prefix, prefix with segment, entry
    different, word = np.unique(t.hash, return_inverse=True)
    n = len(different) + 1
    number = t.lang[at]
    for j in range(k - 1):
        number = np.unique(number * n + word[at + j], return_inverse=True)[1]
    number = number * (int(segment.max(initial=0)) + 1) + segment
    number = np.unique(number, return_inverse=True)[1]
    entry = number * n + np.where(whole[at], np.append(word, np.zeros(k, np.int64))[at + k - 1] + 1, 0)
    _, first, count = np.unique(entry, return_index=True, return_counts=True)
    owner = number[first]
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(owner)])
    rep = first[begin]
    lists = pa.array(np.append(begin, len(owner)).astype(np.int32))
    lang = pa.DictionaryArray.from_arrays(pa.array(t.lang[at][rep].astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())
    prefixes = [pa.array(t.hash[at[rep] + j].view(np.int64)) for j in range(k - 1)]
    return pa.RecordBatch.from_arrays(
        [lang, *prefixes, pa.array(segment[rep].astype(np.int32)),
         pa.ListArray.from_arrays(lists, pa.array(following[first].view(np.int64))),
         pa.ListArray.from_arrays(lists, pa.array(count.astype(np.int64)))],
        ["lang", *WORDS[:k - 1], "segment", "next", "count"])


def merge_sorted(batches: Iterator[pa.RecordBatch], keys: list[str], least: int) -> Iterator[pa.RecordBatch]:
    """Merge neighbouring stripes of equal keys elementwise.

    Gives the total of each stripe and its entries of ``least`` or more.  The last
    stripe of a batch waits, merged so far, for the next batch.
    """
    waiting: pa.RecordBatch | None = None

    def columns(table: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        names = table.column(keys[0]).dictionary_encode()
        change = np.ones(table.num_rows, bool)
        for c in (names.indices, *(table.column(x) for x in keys[1:])):
            v = c.to_numpy(zero_copy_only=False)
            change[1:] &= v[1:] == v[:-1]
        change[1:] = ~change[1:]
        group = np.cumsum(change) - 1
        lists = table.column("next")
        owner = np.repeat(group, np.diff(lists.offsets.to_numpy()))
        nxt, cnt = lists.flatten().to_numpy(), table.column("count").flatten().to_numpy()
        order = np.lexsort((nxt, owner))
        owner, nxt = owner[order], nxt[order]
        begin = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (nxt[1:] != nxt[:-1]))[:len(owner)])
        return np.flatnonzero(change), owner[begin], nxt[begin], np.add.reduceat(cnt[order], begin) if len(begin) else cnt

    def rows(table: pa.RecordBatch, first: np.ndarray, owner: np.ndarray, nxt: np.ndarray, cnt: np.ndarray,
             final: bool) -> pa.RecordBatch:
        """Rows of these groups (owner counts from 0); if final with totals and frequent entries only."""
        out = [table.column(x).take(pa.array(first)) for x in keys]
        if final:
            total = np.bincount(owner, weights=cnt, minlength=len(first)).astype(np.int64)
            keep = (cnt >= least) & (nxt != 0)
            owner, nxt, cnt = owner[keep], nxt[keep], cnt[keep]
        lists = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=len(first)))).astype(np.int32))
        out += [pa.ListArray.from_arrays(lists, pa.array(x)) for x in (nxt, cnt)]
        return pa.RecordBatch.from_arrays(out + ([pa.array(total)] if final else []),
                                          [*keys, "next", "count"] + (["total"] if final else []))

    for batch in batches:
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch.cast(waiting.schema)]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        first, owner, nxt, cnt = columns(batch)
        last = len(first) - 1
        done = owner < last
        waiting = rows(batch, first[last:], owner[~done] - last, nxt[~done], cnt[~done], False)
        if last:
            yield rows(batch, first[:-1], owner[done], nxt[done], cnt[done], True)
    if waiting is not None:
        first, owner, nxt, cnt = columns(waiting)
        yield rows(waiting, first, owner, nxt, cnt, True)


def stripes(source: DataFrame, k: int, seed: int, frequent: Filter, hot: Hot, least: int) -> DataFrame:
    """Merged stripes: (lang, w1..w(k-1), segment, next, count, total)."""
    keys = ["lang", *WORDS[:k - 1], "segment"]
    kinds = ["string", *["long"] * (k - 1), "int"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(keys, kinds)) + ", next array<long>, count array<long>"
    shared = source.sparkSession.sparkContext.broadcast((frequent, hot))     # FILTER_BITS and HOT_PREFIXES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, names, lang_hash in _rows(batches, seed):
            yield chunk_stripes(t, k, names, lang_hash, *shared.value)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return merge_sorted(batches, keys, least)

    return (source.mapInArrow(run, schema).repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(merge, schema + ", total long"))


def count_phrases(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> list[DataFrame]:
    """Frequent phrases of 1 to LONGEST words, a written table for each length.

    The first has all words: (lang, w1, word, f).  The others have (lang, w1..wk,
    f, total), ``total`` being the count of the phrase without its last word.
    """
    source = docs.select(F.coalesce(docs[lang_col], F.lit(UNKNOWN)).alias("lang"),
                         F.coalesce(docs[text_col], F.lit("")).alias("text"))
    for seed in range(16):
        words = written(count_words(source, seed), "phrases-1")
        if words.groupBy("w1").agg(F.min("word").alias("a"), F.max("word").alias("b")).filter("a <> b").isEmpty():
            break
    else:
        raise RuntimeError("no seed without equal hashes of different words")
    all_words = words.agg(F.sum("f")).first()[0] or 0
    levels = [words]
    for k in range(2, LONGEST + 1):
        known = levels[-1].filter(F.col("f") >= least)
        count = known.count()
        merged = stripes(source, k, seed, build_filter(known, k - 1, count), find_hot(known, k - 1, all_words), least)
        prefix = ["lang", *WORDS[:k - 1]]
        if count == 0:
            merged = merged.limit(0)
        # the segments of a stripe add up to the prefix total
        total = F.sum("total").over(Window.partitionBy(*prefix))
        merged = merged.withColumn("total", total).filter(F.size("next") > 0)
        entries = merged.select(*prefix, "total", F.explode(F.arrays_zip("next", "count")).alias("e"))
        levels.append(written(entries.select(*prefix, F.col("e.next").alias(WORDS[k - 1]), F.col("e.count").alias("f"), "total"),
                              f"phrases-{k}"))
    return levels


# ---------------------------------------------------------------- collocations

def _padded(df: DataFrame, k: int) -> DataFrame:
    return df.withColumns({w: F.lit(0).cast("long") for w in WORDS[k:]})


def subsumption(levels: list[DataFrame]) -> DataFrame:
    """(lang, w1..w4, longer): the highest count of a frequent phrase that is one word longer.

    A phrase of more words holds one that is one word longer and at least as frequent.
    """
    parts = []
    for k in range(3, LONGEST + 1):
        for words in (WORDS[:k - 1], WORDS[1:k]):
            parts.append(_padded(levels[k - 1].select(
                "lang", *(F.col(w).alias(to) for w, to in zip(words, WORDS)), "f"), k - 1).select("lang", *WORDS, "f"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("lang", *WORDS).agg(F.max("f").alias("longer"))


def _asked(k: int) -> list[tuple[int, int]]:
    """(first word, words) whose counts a phrase looks up: its words and the parts of its cuts.

    The part without the last word is not asked for: its count is the stripe's total.
    """
    parts = {(j, 1) for j in range(1, k + 1)}
    for c in range(1, k):
        if c < k - 1:
            parts.add((1, c))
        parts.add((c + 1, k - c))
    return sorted(parts)


def collocations(docs: DataFrame, least: int = 30, subsumed_percent: int = 80, scale: int = 2_000_000, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language."""
    levels = count_phrases(docs, least, text_col, lang_col)
    name = ["lang", *WORDS]
    candidates = None
    for k in range(2, LONGEST + 1):
        own = _padded(levels[k - 1].withColumnsRenamed({"f": "a"}), k).select(*name, F.lit(k).alias("k"), "a", "total")
        candidates = own if candidates is None else candidates.union(own)
    kept = (candidates.join(subsumption(levels), name, "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * subsumed_percent)).drop("longer"))

    # counts of words and parts; a word's count lies under SALTS keys, as many phrases ask for a frequent word
    words = levels[0].filter(F.col("f") >= least)
    salted = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    counts = _padded(salted, 1).select(*name, "salt", "f", "word")
    for k in range(2, LONGEST):
        counts = counts.union(_padded(levels[k - 1], k).select(*name, F.lit(0).alias("salt"), "f", F.lit(None).cast("string").alias("word")))

    def request(first: int, length: int) -> Column:
        asked = [F.col(WORDS[first - 1 + j]) if j < length else F.lit(0).cast("long") for j in range(4)]
        salt = F.pmod(F.hash(*name), F.lit(SALTS)) if length == 1 else F.lit(0)
        return F.struct(F.lit(first).alias("first"), F.lit(length).alias("length"), salt.alias("salt"),
                        *(c.alias(f"q{j + 1}") for j, c in enumerate(asked)))

    requests = F.when(F.col("k") == 2, F.array(*(request(*p) for p in _asked(2))))
    for k in range(3, LONGEST + 1):
        requests = requests.when(F.col("k") == k, F.array(*(request(*p) for p in _asked(k))))
    asked = kept.withColumn("q", F.explode(requests)).select("*", "q.*").drop("q")
    counts = counts.select("lang", *(F.col(w).alias(f"q{j + 1}") for j, w in enumerate(WORDS)), "salt", "f", "word")
    told = asked.join(counts, ["lang", "q1", "q2", "q3", "q4", "salt"])
    part = F.struct((F.col("first") * 10 + F.col("length")).alias("part"), "f")
    found = told.groupBy(*name, "k", "a", "total").agg(
        F.map_from_entries(F.collect_list(part)).alias("f"),
        F.array_sort(F.collect_list(F.when(F.col("length") == 1, F.struct("first", "word")))).alias("spelt"))

    def cut(k: int, c: int) -> Column:
        left = F.col("total") if c == k - 1 else F.col("f")[10 + c]
        right = F.col("f")[(c + 1) * 10 + k - c]
        score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {scale}")
        return F.struct(F.call_function("div", score, (left + right).cast("decimal(20,0)")).alias("score"),
                        F.lit(c).alias("c"), left.alias("l"), right.alias("r"))

    best = F.when(F.col("k") == 2, cut(2, 1))
    for k in range(3, LONGEST + 1):
        best = best.when(F.col("k") == k, F.least(*(cut(k, c) for c in range(1, k))))
    totals = levels[0].groupBy("lang").agg(F.sum("f").alias("n"))
    scored = (found.withColumn("best", best)
              .select("lang", F.array_join(F.transform("spelt", lambda s: s["word"]), " ").alias("phrase"), "a",
                      F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the limit of a ranked report: Spark keeps ``top`` rows of a language per task before it shuffles
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
