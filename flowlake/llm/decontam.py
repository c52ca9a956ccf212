"""Benchmark decontamination by template canonicalisation (DataFrame functions only).

A text becomes a template: numbers, names and units turn into the typed
placeholders 0, 1 and 2, everything else into lower-case letter runs.

1. *Search*: every window of K template words of every document is hash-joined
   with every window of all benchmark items.  Items of fewer words have one window
   of their full length, and documents are probed at every place for it too.
2. *Alignment*: for the few (document, item) pairs found, hits are grouped by
   alignment (place in the document less place in the item).  So a text that
   holds an item twice, or an item that repeats itself, is judged copy by copy.
3. *Slots*: in an alignment each value of the item's slots must always meet the
   same value in the document; its consistency is the share of the item's distinct
   slot values that do (1 without slots).  A question with new numbers stays
   consistent, a chance match of placeholders does not.  Alignments under
   LEAST_CONSISTENCY are dropped.
4. *Score*: words put in or left out shift the alignment, so alignments that lie
   within a band of BAND places (in either of two bandings, half a band apart)
   are one copy.  ``coverage`` is the share of the item's windows that the band
   holds; from LEAST_COVERAGE on, the pair is a leak, reported by its best band.

The benchmark's windows are broadcast only up to BROADCAST_WINDOWS (about 32
bytes each); beyond that the same join shuffles.

Defined cases: null and empty texts and items, and items without a word, match
nothing; repeated items are separate items; rows with the same doc_id are
scored apart and the best pair is kept; very long texts and long runs of numbers
or names are searched whole (no pattern recurses); the four private-use
characters that mark slots are taken out of texts; an empty table on either side
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import gathered

K = 8
BAND = 16
LEAST_COVERAGE = 0.3
LEAST_CONSISTENCY = 0.5
BROADCAST_WINDOWS = 500_000

# Patterns of the typed slots, and the units that follow a number.
NUMBER = r"[0-9]+([.,:/][0-9]+)*"
NAME = r"([\p{Ll},;] )(\p{Lu}\p{Ll}+( \p{Lu}\p{Ll}+)*)"
UNITS = ("mm|cm|m|km|in|ft|yd|mi|g|kg|mg|lb|oz|t|ml|l|gal|s|sec|min|h|hr|hours|minutes|seconds|days|weeks|months|years|"
         "usd|eur|gbp|dollars|euros|cents|percent|mph|kmh|hz|khz|mhz|w|kw|kwh|v|kb|mb|gb|tb")
UNIT = rf"0 +({UNITS})([^\p{{L}}]|$)"
WORD = r"[\p{L}012]+"

# The same patterns for the JVM: possessive loops match the same text without recursion.
_NUMBER = r"[0-9]++(?:[.,:/][0-9]++)*+"
_NAME = r"([\p{Ll},;] )(\p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)*+)"
# A slot is a mark of its type, its value and END.
MARKS, END = ("\ue000", "\ue001", "\ue002"), "\ue003"
_UNIT = rf"{END} ++((?i:{UNITS}))([^\p{{L}}]|$)"
_TOKEN = rf"[{MARKS[0]}{MARKS[1]}{MARKS[2]}][^{END}]*+{END}|\p{{L}}++"


def tokens(text: Column) -> Column:
    """Words and marked slots of a text, in order."""
    plain = F.translate(F.coalesce(text, F.lit("")), "".join(MARKS) + END, "")
    numbered = F.regexp_replace(plain, _NUMBER, f" {MARKS[0]}$0{END} ")
    named = F.regexp_replace(numbered, _NAME, f"$1 {MARKS[1]}$2{END} ")
    return F.regexp_extract_all(F.regexp_replace(named, _UNIT, f"{END} {MARKS[2]}$1{END} $2"), F.lit(_TOKEN), F.lit(0))


def word(token: Column) -> Column:
    """A token's template word: 0, 1 or 2 for a slot, else the word in lower case."""
    mark = F.substring(token, 1, 1)
    out = F.lower(token)
    for code, m in enumerate(MARKS):
        out = F.when(mark == m, F.lit(str(code))).otherwise(out)
    return out


def slot_value(token: Column) -> Column:
    """``type:value`` of a slot, NULL for a word; units in lower case."""
    mark, value = F.substring(token, 1, 1), F.substring(token, F.lit(2), F.length(token) - 2)
    out = F.lit(None).cast("string")
    for code, m in enumerate(MARKS):
        out = F.when(mark == m, F.concat(F.lit(f"{code}:"), F.lower(value) if code == 2 else value)).otherwise(out)
    return out


def template(text: Column) -> Column:
    """The template words of a text, with 0 / 1 / 2 for numbers / names / units."""
    return F.transform(tokens(text), word)


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_WINDOWS else df


def _tokenized(df: DataFrame, text: str) -> DataFrame:
    """With ``tokens`` and the ``hashes`` of their template words, each computed once."""
    return (df.withColumn("tokens", tokens(F.col(text)))
            .withColumn("hashes", F.transform("tokens", lambda t: F.xxhash64(word(t)))))


def _sized_windows(df: DataFrame, sizes: list[int], values: bool = False) -> DataFrame:
    """With ``windows``: (hash, size, at[, values]) of all windows of all these sizes.

    ``values`` adds the slot values of a window's places (NULL for words), so that
    later rows carry their window and not their text.
    """
    if values:
        df = df.withColumn("values", F.transform("tokens", slot_value))

    def sized(n: int) -> Column:
        last = F.size("hashes") - n + 1
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))

        def window(i: Column) -> Column:
            # element by element: slice() would copy the whole array for every window
            own = [F.array(*(F.get("values", i - 1 + j) for j in range(n))).alias("values")] if values else []
            hashed = F.xxhash64(*(F.get("hashes", i - 1 + j) for j in range(n)))
            return F.struct(hashed.alias("hash"), F.lit(n).alias("size"), i.alias("at"), *own)

        return F.transform(places, window)

    empty = "array<struct<hash:bigint,size:int,at:int" + (",values:array<string>" if values else "") + ">>"
    return df.withColumn("windows", F.concat(*map(sized, sizes)) if sizes else F.array().cast(empty))


def _each_window(df: DataFrame, *columns: str) -> DataFrame:
    """A row ``w`` per window.  The outer form, as for the inner one Spark adds a filter
    that holds the whole expression again, spelt out for every element."""
    return df.select(*columns, F.explode_outer("windows").alias("w")).filter("w is not null")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_matched, n_windows, coverage, consistency) of every leak."""
    leaks = _leaks(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), benchmark, item_col, item_text_col)
    best = F.max(F.struct("coverage", "consistency", "n_matched", "n_windows"))
    pairs = (leaks.groupBy("doc_id", "item_id").agg(best.alias("best"))
             .select("doc_id", "item_id", F.col("best.n_matched").cast("long").alias("n_matched"),
                     F.col("best.n_windows").cast("long").alias("n_windows"), "best.coverage", "best.consistency"))
    return gathered(pairs, "leaking-pairs")


def _leaks(source: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """Every leaking band of every row (doc_id, row_key) and item."""
    source = source.withColumn("row_key", F.xxhash64("doc_id", "text"))
    items = _tokenized(benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].alias("item_text"))
                       .withColumn("item_key", F.xxhash64("item_id", "item_text")).dropDuplicates(["item_key"]), "item_text")
    items = items.withColumn("size", F.least(F.size("tokens"), F.lit(K))).filter("size > 0")
    n_windows = F.size("tokens") - F.col("size") + 1
    rows = items.agg(F.sum(n_windows).alias("n")).first()["n"] or 0
    # sizes of items shorter than K, and K: at most K values
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    of_item = (_each_window(_sized_windows(items, sizes, True), "item_key", "size").filter("w.size = size")
               .select("item_key", "size", F.col("w.hash").alias("hash"), F.col("w.at").alias("item_at"), F.col("w.values").alias("item_values")))
    keys = of_item.select("hash", "size", "item_key").distinct()

    # which rows hold which items: nothing but hashes goes through the join
    probes = (_each_window(_sized_windows(_tokenized(source, "text"), sizes), "doc_id", "row_key")
              .select("doc_id", "row_key", F.col("w.hash").alias("hash"), F.col("w.size").alias("size")))
    pairs = (probes.join(_bounded(keys, rows), ["hash", "size"]).select("doc_id", "row_key", "item_key").distinct())

    # all windows of these rows again, with their slot values where they hit
    held = pairs.select(F.col("doc_id").alias("_d"), F.col("row_key").alias("_k")).distinct()
    there = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row_key") == F.col("_k"))
    texts = _sized_windows(_tokenized(source.join(held, there, "left_semi").dropDuplicates(["doc_id", "row_key"]), "text"), sizes, True)
    places = (_each_window(texts, "doc_id", "row_key")
              .select("doc_id", "row_key", F.col("w.hash").alias("hash"), F.col("w.size").alias("size"), F.col("w.at").alias("doc_at"),
                      F.col("w.values").alias("doc_values")))
    hits = (places.join(_bounded(of_item, rows), ["hash", "size"])
            .select("doc_id", "row_key", "item_key", "item_at", (F.col("doc_at") - F.col("item_at")).alias("shift"),
                    F.arrays_zip(F.col("item_values").alias("i"), F.col("doc_values").alias("d")).alias("slots")))

    # one alignment holds a window of the item once, so these sets are bounded by the item
    met = F.filter(F.array_distinct(F.flatten(F.collect_set("slots"))), lambda x: x["i"].isNotNull() & x["d"].isNotNull())
    aligned = hits.groupBy("doc_id", "row_key", "item_key", "shift").agg(F.collect_set("item_at").alias("ats"), met.alias("met"))
    aligned = aligned.withColumn("sides", F.transform("met", lambda x: x["i"])).withColumn("different", F.array_distinct("sides"))
    single = F.filter("different", lambda v: F.size(F.filter("sides", lambda s: s == v)) == 1)
    aligned = (aligned.withColumn("n_single", F.size(single)).withColumn("n_values", F.size("different"))
               .filter((F.col("n_values") == 0) | (F.col("n_single") >= LEAST_CONSISTENCY * F.col("n_values"))))
    halves = F.array(*(F.struct(F.lit(b).alias("half"), F.floor((F.col("shift") + b * (BAND // 2)) / BAND).alias("band")) for b in (0, 1)))
    bands = (aligned.withColumn("h", F.explode(halves)).groupBy("doc_id", "row_key", "item_key", "h")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_set("ats")))).alias("n_matched"),
                  F.sum("n_single").alias("n_single"), F.sum("n_values").alias("n_values")))
    scored = bands.join(_bounded(items.select("item_key", "item_id", n_windows.alias("n_windows")), rows), "item_key")
    return (scored.withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
            .withColumn("consistency", F.when(F.col("n_values") == 0, F.lit(1.0)).otherwise(F.col("n_single") / F.col("n_values")))
            .filter(F.col("coverage") >= LEAST_COVERAGE))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay.

    A row goes if its own text leaks, or that of another row with its id.
    """
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    leaks = gathered(_leaks(own, benchmark, "item_id", "text").select(F.col("doc_id").alias("_leaked"), F.col("row_key").alias("_leaked_row"))
                     .distinct(), "leaks")
    rows = leaks.count()
    by_id = _bounded(leaks.filter("_leaked is not null").select("_leaked").distinct(), rows)
    by_row = leaks.filter("_leaked is null").select("_leaked_row")
    kept = docs.join(by_id, docs[id_col].cast("long") == by_id["_leaked"], "left_anti")
    if by_row.isEmpty():
        return kept
    by_row = _bounded(by_row, rows)
    row_key = F.when(kept[id_col].isNull(), F.xxhash64(kept[id_col].cast("long"), kept[text_col]))
    return kept.join(by_row, row_key == by_row["_leaked_row"], "left_anti")
