"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are letter runs (A-Z folded) and their prefixes of 4 to 8 bytes, which
catch inflected forms.  From a bounded sample of labelled documents the TERMS
most associated with the label (chi-squared over document counts) are kept; all
other words of a text count as one background term, so that the share of telling
words, and not only their mix, decides who is near.

Index: examples in blocks of BLOCK, an inverted list per term, and the largest
weight of each term in each block.  A query adds those maxima to an upper bound
per block, opens blocks from the highest bound down and stops when the K-th best
cosine beats every bound left: the K neighbours are exact.  They vote with
weight 1 / (1 - cosine + 0.01); the vote is calibrated to a probability by
monotone bins over leave-one-out votes of the examples.

Everything broadcast is bounded by TRAIN_DOCS examples and TERMS terms.

Defined cases: null, empty and letterless texts have no terms and score what
term-free examples do (the label's share if there are none); a document labelled
twice counts as toxic if any label says so; null labels are left out; without
labelled rows every score is 0; ties among neighbours go to the earlier example;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import NOT_LETTER, chunk_rows, find_words, text_buffer, written

TRAIN_DOCS = 8_000          # bound of the labelled sample (by id hash)
TERMS = 512
LEAST_CHI2 = 10.83          # p < 0.001 for one term
PREFIXES = (4, 5, 6, 7, 8)
BLOCK = 64
K = 15
BINS = 20


def _distinct_words(data: np.ndarray, offsets: np.ndarray):
    """(words, first place and number of each distinct word, feature hashes per distinct word)."""
    words = find_words(data, offsets, NOT_LETTER, PREFIXES)
    _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    features = np.stack([words.hash[first], *(h[first] for h in words.heads)])
    return words, back, features


def _task_counts(labels: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, documents labelled 1, documents) of one chunk."""
    words, back, features = _distinct_words(data, offsets)
    row = words.row()
    pairs = np.unique(row * len(features[0]) + back) if len(row) else np.zeros(0, np.int64)
    doc, word = np.divmod(pairs, max(len(features[0]), 1))
    terms, docs = [], []
    for f in features:
        h = f[word]
        some = h != 0
        terms.append(h[some])
        docs.append(doc[some])
    term, doc = np.concatenate(terms), np.concatenate(docs)
    order = np.lexsort((doc, term))
    term, doc = term[order], doc[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    term, doc = term[new], doc[new]
    distinct, at = np.unique(term, return_inverse=True)
    return distinct, np.bincount(at, weights=labels[doc], minlength=len(distinct)), np.bincount(at, minlength=len(distinct))


@dataclass
class Terms:
    """Chosen terms in hash order; the background term has the last place."""
    hash: np.ndarray
    idf: np.ndarray

    def vectors(self, column: pa.Array) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
        """Per text: (places, 1 + floor(log2 count)) of its terms, by place."""
        data, offsets = text_buffer(column)
        size = len(self.hash)
        for lo, hi in chunk_rows(offsets):
            words, back, features = _distinct_words(data, offsets[lo:hi + 1])
            found = np.searchsorted(self.hash, features) if size else np.zeros(features.shape, np.int64)
            hit = (self.hash[np.minimum(found, size - 1)] == features) & (features != 0) if size else np.zeros(features.shape, bool)
            telling = hit.any(0)
            row = words.row()
            near = np.flatnonzero(telling[back])
            keys = []
            for f in range(len(features)):
                at = back[near]
                ok = hit[f][at]
                keys.append(row[near][ok] * (size + 1) + found[f][at][ok])
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            rows, place = np.divmod(key, size + 1)
            cut = np.searchsorted(rows, np.arange(hi - lo + 1))
            tf = 1 + np.floor(np.log2(count)).astype(int)
            n_words = np.diff(words.bound)
            other = n_words - np.bincount(row[near], minlength=hi - lo)
            level = np.where(other > 0, 1 + np.floor(np.log2(np.maximum(other, 1))), 0).astype(int)
            for i in range(hi - lo):
                a, b = cut[i], cut[i + 1]
                if level[i]:
                    yield (*place[a:b].tolist(), size), (*tf[a:b].tolist(), int(level[i]))
                else:
                    yield tuple(place[a:b].tolist()), tuple(tf[a:b].tolist())


class Index:
    """Block-max inverted index over the labelled examples."""

    def __init__(self, terms: Terms, rows: list[tuple[int, int, list[int], list[int]]]):
        """rows: (doc_id, label, places, levels)."""
        self.terms = terms
        rows = sorted(rows, key=lambda r: (tuple(r[2]), tuple(r[3]), r[0] if r[0] is not None else -1))
        self.doc_ids = [r[0] for r in rows]
        self.labels = np.array([r[1] for r in rows], float)
        self.n = len(rows)
        n_terms = len(terms.hash) + 1
        blocks = -(-self.n // BLOCK)
        self.block_max = np.zeros((n_terms, blocks))
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        self.empty = [i for i, r in enumerate(rows) if not r[2]]
        for i, (_, _, places, levels) in enumerate(rows):
            at, w = self.weights(places, levels)
            for t, x in zip(at.tolist(), w.tolist()):
                lists[t].append((i, x))
                self.block_max[t, i // BLOCK] = max(self.block_max[t, i // BLOCK], x)
        self.example = [np.array([i for i, _ in p], np.int64) for p in lists]
        self.weight = [np.array([x for _, x in p]) for p in lists]
        # where each block begins in each list
        edges = np.arange(blocks + 1) * BLOCK
        self.begin = [np.searchsorted(e, edges) for e in self.example]
        self.share = float(self.labels.mean()) if self.n else 0.0
        self.memory: dict = {}
        self._calibrate(rows)

    def weights(self, places, levels) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(places, np.int64)
        w = np.array(levels, float) * self.terms.idf[at]
        return at, w / max(np.sqrt((w * w).sum()), 1e-12)

    def nearest(self, places, levels, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the K nearest, by block-max pruning."""
        at, w = self.weights(places, levels)
        bound = w @ self.block_max[at]
        order = np.argsort(-bound, kind="stable")
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        for k in range(0, len(order), 4):
            open_blocks = order[k:k + 4]
            if bound[open_blocks[0]] <= 0 or len(cosines) == K and bound[open_blocks[0]] < cosines[-1]:
                break
            for b in open_blocks:
                score = np.zeros(BLOCK)
                for t, x in zip(at, w):
                    lo, hi = self.begin[t][b], self.begin[t][b + 1]
                    score[self.example[t][lo:hi] - b * BLOCK] += x * self.weight[t][lo:hi]
                members = np.arange(b * BLOCK, min((b + 1) * BLOCK, self.n))
                score = score[:len(members)]
                keep = (score > 0) & (members != without)
                best, cosines = np.append(best, members[keep]), np.append(cosines, score[keep])
            top = np.lexsort((best, -np.round(cosines, 12)))[:K]
            best, cosines = best[top], cosines[top]
        return best, cosines

    def vote(self, places, levels, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        if not len(places):
            own = [i for i in self.empty if i != without]
            return (float(self.labels[own].mean()) if own else self.share), np.array(own[:K], np.int64), np.ones(len(own[:K]))
        best, cosines = self.nearest(places, levels, without)
        if not len(best):
            return self.share, best, cosines
        w = 1 / (1 - np.minimum(cosines, 1) + 0.01)
        return float((w * self.labels[best]).sum() / w.sum()), best, cosines

    def _calibrate(self, rows) -> None:
        """Monotone bins: the label's share at each level of the leave-one-out vote."""
        self.levels, self.chance = np.array([0.0]), np.array([self.share])
        if self.n < 2:
            return
        votes = np.array([self.vote(r[2], r[3], i)[0] for i, r in enumerate(rows)])
        at = np.minimum((votes * BINS).astype(int), BINS - 1)
        total = np.bincount(at, minlength=BINS).astype(float)
        level = np.bincount(at, weights=votes, minlength=BINS)
        positive = np.bincount(at, weights=self.labels, minlength=BINS)
        pools: list[list[float]] = []         # [examples, sum of votes, labels 1], pooled while falling
        for n, v, p in zip(total, level, positive):
            if n:
                pools.append([n, v, p])
            while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last)]
        self.levels = np.array([v / n for n, v, _ in pools])
        self.chance = np.array([p / n for n, _, p in pools])

    def score(self, places, levels) -> tuple[float, str]:
        if not self.n:
            return 0.0, ""
        key = (places, levels)
        if key not in self.memory:
            if len(self.memory) > 50_000:
                self.memory.clear()
            vote, best, cosines = self.vote(places, levels)
            evidence = ",".join(f"{self.doc_ids[i]}:{c:.3f}" for i, c in zip(best[:3], cosines[:3]))
            self.memory[key] = float(np.interp(vote, self.levels, self.chance)), evidence
        return self.memory[key]


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most: int = TRAIN_DOCS) -> Index:
    """The index over about ``most`` labelled rows, chosen by a hash of the id.

    ``usable`` is a condition on ``labels``.  Only those rows' ids (bounded) are
    broadcast, and only counts of terms and the examples' vectors are collected.
    """
    known = (labels.filter(usable & labels[label_col].isNotNull() & labels[id_col].isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("label")))
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    sample = written(texts.join(F.broadcast(known), "id").select("id", "label", "text"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy().astype(float)
            data, offsets = text_buffer(batch.column("text"))
            for lo, hi in chunk_rows(offsets, 4 << 20):
                term, one, every = _task_counts(label[lo:hi], data, offsets[lo:hi + 1])
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(one), pa.array(every.astype(float))], ["term", "one", "every"])

    total = sample.agg(F.count("*").cast("double").alias("n"), F.sum("label").cast("double").alias("one")).first()
    n_docs, n_one = total["n"], total["one"] or 0.0
    if not n_docs:
        return Index(Terms(np.zeros(0, np.uint64), np.ones(1)), [])
    counts = (sample.mapInArrow(count, "term long, one double, every double")
              .groupBy("term").agg(F.sum("one").alias("a"), F.sum("every").alias("df")))
    # 2 x 2 table: a labelled 1 with the term, b labelled 0 with it, c and d without it
    a, df, one, docs_n = F.col("a"), F.col("df"), F.lit(n_one), F.lit(n_docs)
    cross = a * (docs_n - one - df + a) - (df - a) * (one - a)
    chi2 = F.try_divide(docs_n * cross * cross, one * (docs_n - one) * df * (docs_n - df))
    chosen = (counts.withColumn("chi2", chi2).filter((F.col("chi2") >= LEAST_CHI2) & (cross > 0) & (df >= 3))
              .orderBy(F.desc("chi2"), "term").limit(TERMS).collect())
    chosen = sorted(chosen, key=lambda r: np.int64(r["term"]).view(np.uint64))
    hashes = np.array([r["term"] for r in chosen], np.int64).view(np.uint64)
    idf = np.append(np.log((n_docs + 1) / (np.array([r["df"] for r in chosen]) + 0.5)), 0.25)
    terms = Terms(hashes, idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(terms.vectors(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([list(p) for p, _ in rows], pa.list_(pa.int32())),
                 pa.array([list(x) for _, x in rows], pa.list_(pa.int32()))], ["id", "label", "places", "levels"])

    rows = sample.mapInArrow(vectors, "id long, label int, places array<int>, levels array<int>").collect()
    return Index(terms, [(r["id"], r["label"], r["places"], r["levels"]) for r in rows])


def score_toxicity(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, evidence (nearest examples with their cosine) of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = [index.score(*v) for v in index.terms.vectors(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.float64()),
                                              pa.array([r[1] for r in rows], pa.string())], ["doc_id", "score", "evidence"])

    return source.mapInArrow(run, "doc_id long, score double, evidence string")
