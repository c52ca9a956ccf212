"""Main text of web pages by union-free wrappers inferred per host.

A page is a nested token stream.  Its *pattern* is a union-free regular
expression over that stream: an element with an ordered list of child patterns,
where a child may be repeated (+) or optional (?), and text slots.

Inference aligns the streams of a host one after another:

* siblings with one key that follow each other become one repeated group, as do
  adjacent equal runs of up to RUN siblings;
* two patterns are aligned child list by child list (longest common subsequence
  of keys); what only one side has becomes optional;
* a text slot remembers how much text, how much link text and whether all pages
  had the same text there, and up to LEAST_SAME_PAGES different pages it was on.

Each task folds its own pages into one pattern per host; those partial patterns
are merged per host and salt, then per host.  Their size follows the variety of
a host's templates, not its number of pages.

A host's slots are then judged once: slots under menus, headers, footers, forms,
adverts and the like never count; if the host marks an article, its slots are
the main text, else those of the element that keeps most of the host's running
text, without slots whose text never changes between different pages or that
are mostly links.  Class and id words are weaker evidence than tags: they mark
nothing on html and body, nor after words such as "no" or "has", and on a host
without another article a layout word does not condemn the element that holds
MOST of the running text.  Extraction matches each page with its host's pattern
and joins the text of main slots; a page that gets no text so is judged by its
own pattern, so an article is not lost to its neighbours or copies.

Patterns are broadcast up to BROADCAST_BYTES in sum; beyond, they are joined by
host.

Defined cases: null or empty html, or no main slot: empty text; a null or odd
url has the empty host (such pages share a wrapper); unclosed and stray tags are
closed by nesting rules, never dropped with their text; raw script and style
content and comments are skipped whole, to the end of the page if unclosed;
repeated rows are extracted alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import written

RUN = 4                         # longest sibling run that folds into a repeated group
DEPTH = 100                     # deeper elements count to their ancestor of this depth
BROADCAST_BYTES = 16 << 20
LEAST_SAME_PAGES = 3            # different pages before "the same text everywhere" means template text
MOST = 0.8                      # share of the host's running text
SALTS = 64                      # partial patterns of a host are merged in so many groups first

# Element roles of HTML, and words of class and id names that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg canvas object annotation".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr math mi mn mo mrow ms msub msubsup msup mtext".split())
FURNITURE = frozenset("head nav header footer aside form dialog menu button select option fieldset".split()) | RAW
NOT_ARTICLE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent "
                              "popup modal overlay newsletter subscribe subscription signup login comment comments reply replies respond "
                              "disqus".split())
LAYOUT_WORDS = frozenset("banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social "
                         "notice notices alert search form footer header masthead pagination pager skip copyright".split())
#: Words before or after a furniture word in one class that say something about the element, not what it is.
BEFORE = frozenset("no not has have with without layout page".split())
AFTER = frozenset("free open closed enabled disabled".split())
ARTICLE_TAGS = frozenset(["article", "main"])
ROOTS = frozenset(["html", "body"])
#: A start tag of the key closes open elements of the set (up to the nearest container).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}

_MARKUP = re.compile(r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME = re.compile(r"[a-z]+")


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _marked(token: list[str], furniture: frozenset[str]) -> bool:
    """Whether a class or id, in words, names furniture."""
    return any(word in furniture and BEFORE.isdisjoint(token[:k]) and AFTER.isdisjoint(token[k + 1:]) for k, word in enumerate(token))


def _key(tag: str, attributes: str) -> str:
    """Tag with its class words; "!" marks furniture, "?" furniture by layout words alone, "*" an article."""
    words, sure, likely = [], tag in FURNITURE, False
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden":
                sure = sure or tag not in ROOTS and (name == "hidden" or value == "true")
                continue
            tokens = [_NAME.findall(token) for token in value.split()]
            if name != "id":
                words += [word for token in tokens for word in token]
            if tag not in ROOTS:
                sure = sure or any(_marked(token, NOT_ARTICLE_WORDS) for token in tokens)
                likely = likely or any(_marked(token, LAYOUT_WORDS) for token in tokens)
    mark = "!" if sure else "?" if likely else ""
    main = not sure and (tag in ARTICLE_TAGS or "main" in words)
    return ".".join([tag, *sorted(set(words))]) + mark + ("*" if main else "")


class Element:
    __slots__ = ("key", "tag", "page", "items")

    def __init__(self, key: str, tag: str, page: int = 0):
        self.key, self.tag, self.page = key, tag, page     # page: digest of the whole page, at the root
        self.items: list = []          # Element or str (text; "\n" where an inline run breaks)


def parse(page: str) -> Element:
    """The element tree of a page; text keeps its character references."""
    digest = hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=6).digest()
    root = Element("#", "#", int.from_bytes(digest, "little"))
    stack, at = [root], 0
    too_deep: dict[str, int] = {}
    size = len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if not m:
            stack[-1].items.append(page[at:])
            break
        if m.start() > at:
            stack[-1].items.append(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if too_deep.get(tag):
                too_deep[tag] -= 1
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        attributes = m.group(3)
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].items.append("\n")
            continue
        if tag not in INLINE:
            # a block ends an open paragraph, whatever inline elements are open in it
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in CLOSES:
            while len(stack) > 1 and (stack[-1].tag in CLOSES[tag] or stack[-1].tag in INLINE and any(e.tag in CLOSES[tag] for e in stack[-3:])):
                stack.pop()
        child = Element(_key(tag, attributes), tag)
        stack[-1].items.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif len(stack) < DEPTH:
            stack.append(child)
        else:
            too_deep[tag] = too_deep.get(tag, 0) + 1
    return root


# ---------------------------------------------------------------- patterns
# A pattern is a list [key, repeated, optional, children, slot]; a slot is
# [least digests of different pages, characters, link characters, crc of the text, same on all pages].

def _slot(texts: list[str], in_link: bool, page: int) -> list | None:
    text = " ".join("".join(texts).split())
    return [[page], len(text), len(text) if in_link else 0, crc32(text.encode("utf-8", "surrogatepass")), True] if text else None


def _merge_slots(x: list | None, y: list | None) -> list | None:
    if x is None or y is None:
        return x or y
    pages = x[0] if x[0] == y[0] else sorted({*x[0], *y[0]})[:LEAST_SAME_PAGES]
    return [pages, x[1] + y[1], x[2] + y[2], x[3], x[4] and y[4] and x[3] == y[3]]


def pattern(element: Element, in_link: bool = False, page: int = 0) -> list:
    in_link, page = in_link or element.tag == "a", page or element.page
    children = [pattern(x, in_link, page) for x in element.items if isinstance(x, Element)]
    return [element.key, False, False, fold(children), _slot([x for x in element.items if isinstance(x, str)], in_link, page)]


def fold(children: list) -> list:
    """Adjacent siblings of one key, then adjacent runs of equal keys, become repeated groups."""
    out: list = []
    for c in children:
        if out and out[-1][0] == c[0]:
            out[-1] = merge(out[-1], c)
            out[-1][1] = True
        else:
            out.append(c)
    for run in range(2, RUN + 1):
        k = 0
        while k + 2 * run <= len(out):
            if all(out[k + j][0] == out[k + run + j][0] for j in range(run)):
                for j in range(run):
                    out[k + j] = merge(out[k + j], out[k + run + j])
                    out[k + j][1] = True
                del out[k + run:k + 2 * run]
            else:
                k += 1
    return out


def merge(x: list, y: list) -> list:
    """One pattern for two of the same key."""
    return [x[0], x[1] or y[1], x[2] or y[2], _align(x[3], y[3]), _merge_slots(x[4], y[4])]


def _align(xs: list, ys: list) -> list:
    if [c[0] for c in xs] == [c[0] for c in ys]:
        return [merge(a, b) for a, b in zip(xs, ys)]
    n, m = len(xs), len(ys)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if xs[i][0] == ys[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and xs[i][0] == ys[j][0]:
            out.append(merge(xs[i], ys[j]))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([*xs[i][:2], True, *xs[i][3:]])
            i += 1
        else:
            out.append([*ys[j][:2], True, *ys[j][3:]])
            j += 1
    return fold(out)


# ---------------------------------------------------------------- judging

def judge(wrapper: list) -> dict:
    """The wrapper as nested {key, main, children}: whether each slot is main text; skip marks furniture by layout words."""
    kept = _kept(wrapper)
    if _has_article(wrapper, kept):
        return _judge(wrapper, False, kept, None)
    return _judge(wrapper, False, kept, _densest(wrapper, kept))


def _kept(p: list) -> frozenset[int]:
    """Elements that are no furniture though a layout word says so: without another article, those on the way to MOST of the text."""
    every = frozenset(_likely(p))
    if not every or _has_article(p, frozenset()):
        return frozenset()
    total, kept = _running(p, every), set()
    while True:
        inner = [c for c in p[3] if total and _running(c, every) >= MOST * total]
        if not inner:
            return frozenset(kept)
        p = inner[0]
        if id(p) in every:
            kept.add(id(p))


def _likely(p: list) -> Iterator[int]:
    if "?" in p[0]:
        yield id(p)
    for c in p[3]:
        yield from _likely(c)


def _furniture(p: list, kept: frozenset[int]) -> bool:
    return "!" in p[0] or "?" in p[0] and id(p) not in kept


def _has_article(p: list, kept: frozenset[int]) -> bool:
    return not _furniture(p, kept) and (p[0].endswith("*") or any(_has_article(c, kept) for c in p[3]))


def _template(slot: list) -> bool:
    return slot[4] and len(slot[0]) >= LEAST_SAME_PAGES


def _running(p: list, kept: frozenset[int]) -> int:
    """Characters of text that is neither furniture, link nor template text."""
    if _furniture(p, kept):
        return 0
    own = p[4][1] - p[4][2] if p[4] and not _template(p[4]) else 0
    return own + sum(_running(c, kept) for c in p[3])


def _densest(p: list, kept: frozenset[int]) -> list:
    """The deepest element with MOST of the running text that holds blocks."""
    total = _running(p, kept)
    while True:
        inner = [c for c in p[3] if c[3] and not c[1] and total and _running(c, kept) >= MOST * total]
        if not inner:
            return p
        p = inner[0]


def _judge(p: list, inside: bool, kept: frozenset[int], chosen: list | None) -> dict:
    """``chosen``: the element taken for the article on a host that marks none."""
    if _furniture(p, kept):
        return {"key": p[0], "main": False, "children": []} | ({"skip": True} if "?" in p[0] else {})
    inside = inside or (p[0].endswith("*") if chosen is None else p is chosen)
    main = inside
    if main and chosen is not None and p[4]:
        main = not _template(p[4]) and p[4][2] <= p[4][1] / 2
    return {"key": p[0], "main": main, "children": [_judge(c, inside, kept, chosen) for c in p[3]]}


def main_text(page: str, wrapper: dict) -> str:
    """Texts of the page's main slots, blocks joined by one space; by the page's own pattern if the wrapper gives it none."""
    tree = parse(page)
    return _text(tree, wrapper) or _text(tree, judge(pattern(tree)))


def _text(tree: Element, wrapper: dict) -> str:
    out: list[str] = []
    _collect(tree, wrapper, out)
    return " ".join("".join(out).replace("\x00", " ").split())


def _collect(element: Element, node: dict | None, out: list[str]) -> None:
    # a block border is a mark that no text can hold (a reference to NUL is not one to Python)
    block = element.tag not in INLINE
    if block:
        out.append("\x00")
    at, children = 0, node["children"] if node else []
    for item in element.items:
        if isinstance(item, str):
            if node and node["main"]:
                out.append("\x00" if item == "\n" else html.unescape(item.replace("\x00", "\ufffd")))
            continue
        if "!" in item.key:
            continue
        # the pattern's children in order; a repeated run starts over
        k = next((i for i in [*range(at, len(children)), *range(at)] if children[i]["key"] == item.key), None)
        if k is None and "?" in item.key or k is not None and children[k].get("skip"):
            continue
        if k is None:
            # not in the pattern: judged as its parent
            _collect(item, {"key": item.key, "main": bool(node and node["main"]), "children": []}, out)
        else:
            at = k
            _collect(item, children[k], out)
    if block:
        out.append("\x00")


# ---------------------------------------------------------------- Spark

def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): the judged wrapper of every host, as JSON."""
    source = pages.select(pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                if page:
                    own, host = pattern(parse(page)), host_of(url)
                    seen[host] = merge(seen[host], own) if host in seen else own
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([json.dumps(p) for p in seen.values()], pa.string())],
                                         ["host", "pattern"])

    def joined(finish):
        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[str, list] = {}
            for batch in batches:
                for host, text in zip(batch.column("host").to_pylist(), batch.column("pattern").to_pylist()):
                    own = json.loads(text)
                    seen[host] = merge(seen[host], own) if host in seen else own
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([json.dumps(finish(p)) for p in seen.values()], pa.string())],
                                             ["host", "pattern"])
        return join

    schema = "host string, pattern string"
    partial = source.mapInArrow(learn, schema).withColumn("salt", F.pmod(F.xxhash64("pattern"), F.lit(SALTS)))
    salted = (partial.repartition("host", "salt").sortWithinPartitions("host", "pattern").select("host", "pattern")
              .mapInArrow(joined(lambda p: p), schema))
    whole = salted.repartition("host").sortWithinPartitions("host", "pattern").mapInArrow(joined(judge), schema)
    return whole.withColumnRenamed("pattern", "wrapper")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    wrappers = written(infer_wrappers(pages, url_col, html_col), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    source = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                          pages[html_col].cast("string").alias("html"))

    def rows(batch: pa.RecordBatch, wrapper_of) -> pa.RecordBatch:
        texts = []
        for url, page, given in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), wrapper_of(batch)):
            wrapper = given(url)
            texts.append(main_text(page, wrapper) if page and wrapper else "")
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = "page_id long, url string, text string, n_chars long"
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {host: json.loads(text) for host, text in shared.value.items()}
            for batch in batches:
                yield rows(batch, lambda b: [lambda url: known.get(host_of(url))] * b.num_rows)

        return source.mapInArrow(run, schema)

    def hosted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("host", pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string()))

    joined = source.mapInArrow(hosted, "page_id long, url string, html string, host string").join(wrappers, "host", "left")

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, dict] = {}
        for batch in batches:
            def wrapper_of(b: pa.RecordBatch):
                for text in b.column("wrapper").to_pylist():
                    if text is not None and text not in last:
                        last.clear()
                        last[text] = json.loads(text)
                    yield lambda url, text=text: last.get(text) if text is not None else None
            yield rows(batch, wrapper_of)

    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(run_joined, schema)
