"""Personal data: fixed patterns plus a skip-chain conditional random field.

Nodes are the white-space tokens of one document that hold a digit or "@"
(every other token is O by a hard constraint).  Labels are O, email, ip, card
and phone.  Potentials:

* unary: log P(label | shape cell); a cell is a small product of token features
  (digit count, "@", dots, "+", letters, valid checksum, valid octets);
* chain: neighbouring tokens, log of observed over independent label pairs;
* skip: distant tokens with the same text, and tokens with the same digits,
  each linked to its previous occurrence (so a token repeated m times has m-1
  links), with their own label-pair potentials.

All potentials are fitted piecewise from counts over the whole corpus, labelled
by the fixed patterns; the counts have at most CELLS * 5 + 75 keys whatever the
corpus, so collecting them is bounded.  Nodes under a pattern match are clamped;
loopy message passing spreads their labels, and a free node whose marginal
reaches THRESHOLD becomes a span of its own.  Pattern spans always stay.

Defined cases: null and empty texts have no spans (their base digest is that of
the empty string); digits and "@" are the ASCII ones; very long texts are
handled whole, node by node; repeated rows give the same row again; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import chunk_rows, released, text_buffer

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
THRESHOLD = 0.95
ROUNDS = 20
DAMPING = 0.3
SMOOTHING = 0.5

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each "@": the local part is the run before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Pattern matches, by kind in the order of KINDS, then start."""
    spans = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# ---------------------------------------------------------------- the graph

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_MARKS = re.compile("[0-9@]")
_FIRST = re.compile(r"[A-Za-z0-9+(@]")       # a core starts here, after leading punctuation
_LAST = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789)")
CELLS = 6 * 2 * 4 * 2 * 2 * 2 * 2
CHAIN, SAME_TEXT, SAME_DIGITS = 0, 1, 2


class Nodes:
    """Candidate tokens of one text, their cells and their links."""

    def __init__(self, text: str):
        self.start, self.end, self.cell = [], [], []
        self.links: list[tuple[int, int, int]] = []
        texts: dict[str, int] = {}
        numbers: dict[str, int] = {}
        for m in _TOKEN.finditer(text):
            i, raw = len(self.start), m.group()
            if not _MARKS.search(raw):
                continue
            lead, tail = _FIRST.search(raw).start(), len(raw)
            while tail > lead + 1 and raw[tail - 1] not in _LAST:
                tail -= 1
            core, s = raw[lead:tail], m.start() + lead
            digits = "".join(_DIGITS.findall(core))
            if i and text[self.end[-1]:s].isspace():
                self.links.append((i - 1, i, CHAIN))
            self.start.append(s)
            self.end.append(s + len(core))
            self.cell.append(self._cell(core, digits))
            key = core.lower()
            if key in texts:
                self.links.append((texts[key], i, SAME_TEXT))
            elif len(digits) >= 7 and digits in numbers:
                self.links.append((numbers[digits], i, SAME_DIGITS))
            texts[key] = i
            if len(digits) >= 7:
                numbers[digits] = i

    @staticmethod
    def _cell(core: str, digits: str) -> int:
        n = len(digits)
        size = 0 if n == 0 else 1 if n <= 3 else 2 if n <= 7 else 3 if n <= 15 else 4 if n <= 19 else 5
        octets = core.split(".")
        ip = len(octets) == 4 and all(o.isascii() and o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets)
        features = ((size, 6), ("@" in core, 2), (min(core.count("."), 3), 4), (core[:1] == "+", 2),
                    (any(c.isalpha() for c in core), 2), (16 <= n <= 19 and luhn(digits), 2), (ip, 2))
        cell = 0
        for value, size in features:
            cell = cell * size + int(value)
        return cell

    def observed(self, spans: list[Span]) -> list[int]:
        """Label of the pattern match that overlaps a node (the first kind wins), else O."""
        labels = [0] * len(self.start)
        ends = np.array(self.end, np.int64)
        for kind, s, e in sorted(spans, key=lambda x: -KINDS.index(x[0])):
            lo = int(np.searchsorted(ends, s, side="right"))
            for i in range(lo, len(labels)):
                if self.start[i] >= e:
                    break
                labels[i] = LABELS.index(kind)
        return labels


def _counts(text: str) -> Counter:
    """Sufficient statistics of one text: (table, row, column) → count."""
    nodes = Nodes(text)
    labels = nodes.observed(base_spans(text))
    counts = Counter((-1, c, y) for c, y in zip(nodes.cell, labels))
    counts.update((kind, labels[a], labels[b]) for a, b, kind in nodes.links)
    return counts


class Model:
    """Log potentials: unary (cell, label) and three label-pair tables."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        unary = np.full((CELLS, 5), SMOOTHING)
        unary[:, 0] += 1.0                      # an unseen shape is most likely O
        pairs = np.full((3, 5, 5), SMOOTHING)
        for kind, a, b, n in rows:
            if kind < 0:
                unary[a, b] += n
            else:
                pairs[kind, a, b] += n
                if kind != CHAIN:               # skip links have no direction
                    pairs[kind, b, a] += n
        self.unary = np.log(unary / unary.sum(1, keepdims=True))
        joint = pairs / pairs.sum((1, 2), keepdims=True)
        alone = joint.sum(2, keepdims=True) * joint.sum(1, keepdims=True)
        self.pairs = np.log(joint / alone)
        # repeated text always shares a label at least as strongly as not
        agree = np.eye(5, dtype=bool)
        for kind in (SAME_TEXT, SAME_DIGITS):
            self.pairs[kind][agree] = np.maximum(self.pairs[kind][agree], 1.0)

    def marginals(self, nodes: Nodes, labels: list[int]) -> np.ndarray:
        """Loopy sum-product with damping; nodes with a pattern label are clamped."""
        own = self.unary[nodes.cell]
        seen = np.array(labels) > 0
        own[seen] = -30.0
        own[seen, np.array(labels)[seen]] = 0.0
        if nodes.links:
            a, b, kind = np.array(nodes.links).T
            src, dst = np.concatenate([a, b]), np.concatenate([b, a])
            pot = np.concatenate([self.pairs[kind], self.pairs[kind].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            sent = np.zeros((len(src), 5))
            for _ in range(ROUNDS):
                belief = own.copy()
                np.add.at(belief, dst, sent)
                cavity = belief[src] - sent[back]
                raw = cavity[:, :, None] + pot
                top = raw.max(1)
                new = top + np.log(np.exp(raw - top[:, None]).sum(1))
                new -= new.max(1, keepdims=True)
                new = DAMPING * sent + (1 - DAMPING) * new
                change = np.abs(new - sent).max()
                sent = new
                if change < 1e-4:
                    break
            np.add.at(own, dst, sent)
        p = np.exp(own - own.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(pattern spans, spans that the field adds)."""
        base = base_spans(text)
        nodes = Nodes(text)
        if not nodes.start:
            return base, []
        labels = nodes.observed(base)
        if all(labels):
            return base, []
        p = self.marginals(nodes, labels)
        best = p.argmax(1)
        added: list[Span] = []
        for i in np.flatnonzero((best > 0) & (p.max(1) >= THRESHOLD) & (np.array(labels) == 0)):
            kind, s, e = LABELS[best[i]], nodes.start[i], nodes.end[i]
            # only phone numbers run over several tokens
            if kind == "phone" and added and added[-1][0] == kind and text[added[-1][2]:s].isspace() and i and nodes.end[i - 1] == added[-1][2]:
                added[-1] = (kind, added[-1][1], e)
            else:
                added.append((kind, s, e))
        return base, added


# ---------------------------------------------------------------- Spark

def _candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and text; text is null where it holds no digit and no "@" (no node, no match)."""
    text = docs[text_col]
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.when(text.rlike("[0-9@]"), text).alias("text"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Potentials from all documents; each task sends one row per count key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(_counts(text))
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[j] for k in keys], pa.int32()) for j in range(3)] + [pa.array([counts[k] for k in keys], pa.int64())],
            ["kind", "a", "b", "n"])

    source = _candidates(docs, id_col, text_col).select("text").filter("text is not null")
    rows = source.mapInArrow(released(run), "kind int, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    return Model([tuple(r) for r in rows.collect()])


def show(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, n_added long")


def find_personal_data(docs: DataFrame, model: Model | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its spans; fits the model on ``docs`` if none is given."""
    model = model or fit(docs, id_col, text_col)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                if text is None:
                    rows.append((0, 0, 0, 0, empty, "", 0))
                    continue
                base, added = model.spans(text)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in KINDS), hashlib.sha256(show(base).encode()).hexdigest(),
                             show(ordered(base + added)), len(added)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return _candidates(docs, id_col, text_col).mapInArrow(released(run), SCHEMA)


def mask(text: str, spans: list[Span]) -> str:
    """Text with each span replaced by its kind in brackets; of overlapping spans the earliest, then longest."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            if e <= at:
                continue
            s = at
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame, model: Model | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span masked in the text; all rows and columns stay.

    Null texts stay null, texts without a span are unchanged.
    """
    model = model or fit(docs, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunk_rows(text_buffer(batch.column(at))[1]):
                part, out = batch.slice(lo, hi - lo), []
                for text in part.column(at).to_pylist():
                    if text is not None and ("@" in text or _DIGITS.search(text)):
                        base, added = model.spans(text)
                        text = mask(text, base + added)
                    out.append(text)
                columns = list(part.columns)
                columns[at] = pa.array(out, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(released(run), docs.schema)
