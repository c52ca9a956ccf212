"""Language ID: script ranges narrow candidates, Viterbi labels spans of mixed text.

Per word: its letters' scripts keep only languages that use such letters, and
hashed character n-grams (1 to 4, with word edges) score the rest.  Per text:
the best label sequence under the word scores and a cost for each switch of
language, so short foreign-looking words do not break a span.

Most texts need no dynamic program.  With D_k the running advantage of language
k over the language L with the best total, the constant path L is optimal when
no stretch of any D_k rises by more than half the switching cost: a path with q
foreign stretches pays at least q switches, or q-1 when L is absent, and then
gains at most (q-1) costs in all.  Only texts that fail this run the recursion.

Defined cases: null text, or a text without a letter: ``und`` with score 0 and
no spans; a text whose scripts no learned language uses gets the most common
language with score 0; rows without text or language teach nothing; repeated
rows are predicted alike; with nothing to learn from, every text is ``und``;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import SMALL_CHUNK, chunk_rows, find_words, mix64, released, text_buffer

BUCKETS = 1 << 16            # hashed n-gram features
NGRAMS = (1, 2, 3, 4)
SWITCH_COST = 12.0           # nats per change of language
FOREIGN_SCRIPT = -20.0       # score of a word in a script the language does not use

# Starts of Unicode script ranges and the script from there on.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"), (0x1D00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAB30, "latin"), (0xAB70, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Per code point: its script's index if it is a letter, else -1."""
    if "letter" not in _tables:
        table = np.full(0x110000, -1, np.int8)
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x32400)), bool, 0x32400)
        table[:0x32400][is_letter] = _SCRIPT[np.searchsorted(_STARTS, np.flatnonzero(is_letter), side="right") - 1]
        _tables["letter"] = table
    return _tables["letter"]


class DistinctWords:
    """Letters-only forms of distinct words, as code points with edges around them."""

    def __init__(self, words: list[str]):
        code = np.frombuffer(("\n".join(["", *words, ""])).lower().encode("utf-32-le"), np.uint32).astype(np.int64)
        script = _letters()[code]
        keep = (script >= 0) | (code == 10)
        self.code, self.script = code[keep], script[keep]
        edge = np.flatnonzero(self.code == 10)
        self.n = len(words)
        self.word = np.repeat(np.arange(self.n + 1), np.diff(np.append(edge, len(self.code))))
        self.letters = np.diff(edge) - 1

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, bucket) of every n-gram; an edge only begins or ends one."""
        words, buckets, edge = [], [], self.code == 10
        with np.errstate(over="ignore"):
            for n in NGRAMS:
                m = len(self.code) - n + 1
                if m <= 0:
                    continue
                inside = np.ones(m, bool)
                if n == 1:
                    inside &= ~edge
                for j in range(1, n - 1):
                    inside &= ~edge[j:j + m]
                if n == 2:
                    inside &= ~(edge[:m] & edge[1:])
                at = np.flatnonzero(inside)
                h = np.full(len(at), n, np.uint64)
                for j in range(n):
                    h = h * np.uint64(1_000_003) + self.code[at + j].astype(np.uint64)
                buckets.append((mix64(h) % np.uint64(BUCKETS)).astype(np.int64))
                words.append(self.word[at])          # an edge counts to the word after it
        w, b = np.concatenate(words), np.concatenate(buckets)
        good = w < self.n
        return w[good], b[good]


class Model:
    """Log-probabilities of n-gram buckets and the scripts each language uses."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray, docs: np.ndarray):
        self.languages = languages
        smooth = counts + 0.1
        self.log = np.log(smooth / smooth.sum(0)).astype(np.float32)          # bucket, language
        total = np.maximum(scripts.sum(0, keepdims=True), 1)
        self.uses = scripts / total >= 0.01                                    # script, language
        self.common = int(np.argmax(docs)) if len(languages) else -1

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores by language, letters) of distinct words; 0 where no language fits the script."""
        d = DistinctWords(words)
        size = len(self.languages)
        w, b = d.features()
        score = np.empty((d.n, size), np.float32)
        # half the sum: overlapping n-grams count every letter several times
        for k in range(size):
            score[:, k] = np.bincount(w, weights=self.log[b, k], minlength=d.n) * 0.5
        seen = np.zeros((d.n, len(SCRIPT_NAMES)), bool)
        is_letter = d.script >= 0
        seen[d.word[is_letter], d.script[is_letter]] = True
        misfit = (seen.astype(np.float32) @ (~self.uses).astype(np.float32)) > 0
        nobody = misfit.all(1)
        score[misfit] = np.minimum(score[misfit], 0) + FOREIGN_SCRIPT
        score -= score.max(1, keepdims=True)        # only differences matter
        score[nobody | (d.letters[:d.n] == 0)] = 0
        return score, np.where(nobody, 0, d.letters[:d.n])


def viterbi(score: np.ndarray, cost: float = SWITCH_COST) -> np.ndarray:
    """Best label per word; on ties the earlier language."""
    n, size = score.shape
    total = score.sum(0, dtype=np.float64)
    best = int(total.argmax())
    gain = np.cumsum(score - score[:, [best]], axis=0, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros(size), gain[:-1]]), axis=0), 0)
    if n == 0 or (gain - low).max() <= cost / 2:
        return np.full(n, best)
    here = score[0].astype(np.float64).tolist()
    came = []
    for row in score[1:].tolist():
        top = max(here)
        at = here.index(top)
        top -= cost
        back, now = [], []
        for k in range(size):
            if here[k] >= top:
                back.append(k)
                now.append(here[k] + row[k])
            else:
                back.append(at)
                now.append(top + row[k])
        came.append(back)
        here = now
    path = [here.index(max(here))]
    for back in reversed(came):
        path.append(back[path[-1]])
    return np.array(path[::-1])


class Labeller:
    """Labels the texts of a batch with word scores computed once per distinct word."""

    def __init__(self, model: Model):
        self.model = model

    def rows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """Per text: word starts and ends (bytes), label, letters and scores per word."""
        if not self.model.languages:
            for _ in range(len(column)):
                yield (np.zeros(0, np.int64),) * 4 + (np.zeros((0, 0)),)
            return
        data, offsets = text_buffer(column)
        for lo, hi in chunk_rows(offsets, SMALL_CHUNK):
            words = find_words(data, offsets[lo:hi + 1])
            _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
            raw = words.data.tobytes()
            spans = zip(words.start[first].tolist(), words.end[first].tolist())
            score, letters = self.model.word_scores([raw[s:e].decode() for s, e in spans])
            for i in range(hi - lo):
                a, b = words.bound[i], words.bound[i + 1]
                own = back[a:b]
                s = score[own]
                yield words.start[a:b], words.end[a:b], viterbi(s), letters[own], s


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Counts over all labelled rows.

    What reaches the driver is one row per (language, bucket) with a count.
    """
    rows = docs.filter(usable & docs[text_col].isNotNull() & docs[lang_col].isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            data, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunk_rows(offsets, SMALL_CHUNK):
                words = find_words(data, offsets[lo:hi + 1])
                raw = words.data.tobytes()
                _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
                d = DistinctWords([raw[s:e].decode() for s, e in zip(words.start[first].tolist(), words.end[first].tolist())])
                w, b = d.features()
                is_letter = d.script >= 0
                row = words.row()
                own = np.array(langs[lo:hi], dtype=object)
                for lang in set(langs[lo:hi]):
                    times = np.bincount(back[own[row] == lang], minlength=d.n).astype(float)
                    if lang not in grams:
                        grams[lang], scripts[lang], docs_of[lang] = np.zeros(BUCKETS), np.zeros(len(SCRIPT_NAMES)), 0
                    grams[lang] += np.bincount(b, weights=times[w], minlength=BUCKETS)
                    scripts[lang] += np.bincount(d.script[is_letter], weights=times[d.word[is_letter]], minlength=len(SCRIPT_NAMES))
                    docs_of[lang] += int((own == lang).sum())
        for lang in grams:
            # keys: buckets, then scripts, then the number of documents
            values = np.concatenate([grams[lang], scripts[lang], [docs_of[lang]]])
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(values[at], pa.float64())],
                                             ["lang", "key", "n"])

    sums = rows.mapInArrow(released(run), "lang string, key int, n double").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    lang_column = sums.column("lang").combine_chunks()
    languages = sorted(pc.unique(lang_column).to_pylist())
    place = {x: i for i, x in enumerate(languages)}
    full = np.zeros((BUCKETS + len(SCRIPT_NAMES) + 1, len(languages)))
    full[sums.column("key").to_numpy(), [place[x] for x in lang_column.to_pylist()]] = sums.column("n").to_numpy()
    return Model(languages, full[:BUCKETS], full[BUCKETS:-1], full[-1])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, n_spans per row (narrow: no shuffle); with ``spans``
    also the labelled byte ranges of the lower-cased-free original text as
    ``lang:start:end``.

    lang_pred has the most letters of the labelled words (ties: the language
    first in order); score is its share of the letters times the certainty of
    its total over the runner-up.
    """
    schema = "doc_id long, lang_pred string, score double, n_spans int" + (", spans string" if spans else "")
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            langs, scores, counts, shown = [], [], [], []
            for row in (label_row(model, x, spans) for x in labeller.rows(batch.column("text"))):
                langs.append(row[0])
                scores.append(row[1])
                counts.append(row[2])
                shown.append(row[3])
            for i in [i for i, x in enumerate(langs) if x == "und"]:
                text = batch.column("text")[i].as_py()
                if model.languages and text and any(map(str.isalpha, text)):
                    langs[i] = model.languages[model.common]      # letters, but of no learned script
            columns = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int32())]
            names = ["doc_id", "lang_pred", "score", "n_spans"]
            if spans:
                columns.append(pa.array(shown, pa.string()))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(released(run), schema)


def label_row(model: Model, row: tuple, spans: bool) -> tuple[str, float, int, str]:
    start, end, label, letters, score = row
    total = int(letters.sum())
    if not total or not model.languages:
        return "und", 0.0, 0, ""
    by = np.bincount(label, weights=letters, minlength=len(model.languages))
    best = int(by.argmax())
    cut = np.flatnonzero(np.diff(label)) + 1
    sums = score[label == best].sum(0, dtype=np.float64)
    rest = np.delete(sums, best)
    margin = float(sums[best] - rest.max()) if len(rest) else 30.0
    certainty = 1.0 / (1.0 + np.exp(-min(max(margin, 0.0), 30.0)))
    shown = ""
    if spans:
        first, last = np.append(0, cut), np.append(cut, len(label)) - 1
        shown = ",".join(f"{model.languages[label[a]]}:{start[a]}:{end[b]}" for a, b in zip(first, last))
    return model.languages[best], float(by[best] / total * certainty), len(cut) + 1, shown


def accepted(docs: DataFrame, model: Model, least: float = 0.2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose language is known with a score of ``least`` or more; all columns stay."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            keep = [row[0] != "und" and row[1] >= least
                    for row in (label_row(model, x, False) for x in labeller.rows(batch.column(at)))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
