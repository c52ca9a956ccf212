"""The registered ``opN_<name>`` queries: each operator on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.common import in_fold, table, work_path
from flowlake.llm.registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES"]


@register("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.bpe import encode_documents
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op5_codes")
def op5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.codes import read_documents, write_codes
    path = work_path(spark, "codes")
    write_codes(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return read_documents(spark, path)


@register("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.pii import find_personal_data
    return find_personal_data(table(spark, sf_dir, "documents"))


@register("op4_langid")
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.langid import fit, predict
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 4, 2)
    return (predict(docs, fit(docs, ~held_out))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_spans"))


#: Exact components: all pairs of sets that share a shingle, then reachability.
_OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id, min(r.other) = s.doc_id AS kept
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""


@register("op6_near_duplicates", _OP6_SQL)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.neardup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def _op3_sql() -> str:
    """All windows of all texts joined by their words, judged alignment by alignment."""
    from flowlake.llm import decontam as d

    def lines(table_: str, key: str) -> str:
        return f"""SELECT {key} AS id, text,
  regexp_replace(coalesce(text, ''), '{d.NUMBER}', ' 0 ', 'g') AS numbered,
  lower(regexp_replace(numbered, '{d.NAME}', '\\1 1 ', 'g')) AS named,
  regexp_extract_all(regexp_replace(named, '{d.UNIT}', '0 2 \\2', 'g'), '{d.WORD}') AS w
FROM {table_}"""

    def values(source: str) -> str:
        """Each slot place with its kind and value."""
        pick = f"""CASE kind WHEN '0' THEN regexp_extract_all(text, '{d.NUMBER}')[ordinal]
    WHEN '1' THEN regexp_extract_all(numbered, '{d.NAME}', 2)[ordinal]
    ELSE regexp_extract_all(named, '{d.UNIT}', 1)[ordinal] END"""
        return f"""SELECT id, place, kind || ':' || {pick} AS v FROM (
  SELECT *, row_number() OVER (PARTITION BY id, kind ORDER BY place) AS ordinal FROM (
    SELECT id, text, numbered, named, unnest(w) AS kind, unnest(range(1, len(w) + 1)) AS place FROM {source})
  WHERE kind IN ('0', '1', '2'))"""

    def windows(source: str, size: str) -> str:
        return f"""SELECT id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: {{'at': i, 'words': w[i:i + size - 1]}}), recursive := true)
FROM (SELECT *, {size} AS size FROM {source})"""

    return f"""WITH doc AS ({lines('documents', 'doc_id')}), item AS (SELECT * FROM ({lines('benchmark', 'item_id')}) WHERE len(w) > 0),
item_window AS ({windows('item', f'least(len(w), {d.K})')}),
doc_window AS ({windows('(SELECT doc.*, asked FROM doc, (SELECT DISTINCT size AS asked FROM item_window))', 'asked')}),
hit AS (SELECT d.id AS doc_id, i.id AS item_id, d.at - i.at AS shift, i.at AS item_at, i.size
  FROM doc_window d JOIN item_window i ON d.size = i.size AND d.words = i.words),
met AS (SELECT DISTINCT hit.doc_id, hit.item_id, shift, iv.v AS iv, dv.v AS dv
  FROM hit, unnest(range(0, hit.size)) AS step(j), ({values('item')}) iv, ({values('doc')}) dv
  WHERE iv.id = hit.item_id AND iv.place = hit.item_at + j AND dv.id = hit.doc_id AND dv.place = hit.item_at + shift + j
    AND iv.v IS NOT NULL AND dv.v IS NOT NULL),
slot AS (SELECT doc_id, item_id, shift, count(*) AS n_values, count(*) FILTER (WHERE n = 1) AS n_single
  FROM (SELECT doc_id, item_id, shift, iv, count(*) AS n FROM met GROUP BY ALL) GROUP BY ALL),
kept AS (SELECT DISTINCT hit.doc_id, hit.item_id, shift, item_at, hit.size, coalesce(n_values, 0) AS n_values, coalesce(n_single, 0) AS n_single
  FROM hit LEFT JOIN slot USING (doc_id, item_id, shift)
  WHERE coalesce(n_single >= {d.LEAST_CONSISTENCY} * n_values, true)),
placed AS (SELECT *, half, floor((shift + half * {d.BAND // 2}) / {d.BAND}) AS band FROM kept, (VALUES (0), (1)) AS halves(half)),
judged AS (SELECT doc_id, item_id, half, band, sum(n_single) AS n_single, sum(n_values) AS n_values
  FROM (SELECT DISTINCT doc_id, item_id, half, band, shift, n_single, n_values FROM placed) GROUP BY ALL),
found AS (SELECT doc_id, item_id, half, band, count(DISTINCT item_at) AS n_matched, any_value(size) AS size FROM placed GROUP BY ALL),
scored AS (SELECT doc_id, item_id, n_matched, CAST(len(item.w) - found.size + 1 AS BIGINT) AS n_windows,
    n_matched / n_windows AS coverage, CASE n_values WHEN 0 THEN 1.0 ELSE n_single / n_values END AS consistency
  FROM found JOIN judged USING (doc_id, item_id, half, band) JOIN item ON item.id = item_id)
SELECT * FROM scored WHERE coverage >= {d.LEAST_COVERAGE}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY coverage DESC, consistency DESC) = 1"""


@register("op3_decontamination", _op3_sql())
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.decontam import find_leaks
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op1_fingerprints")
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near``: for rows whose id is divisible by 100, the documents (itself
    included) within three bits of its fingerprint; null for the others."""
    from flowlake.llm.simhash import count_within, with_next
    rows = with_next(table(spark, sf_dir, "documents"))
    near = count_within(rows.select("fp"), rows.filter("doc_id % 100 = 0").select("fp"))

    def like(x: str, y: str):
        return 1 - F.bit_count(F.col(x).bitwiseXOR(F.col(y))) / 64

    def shown(c: str):
        return F.lpad(F.lower(F.hex(F.col(c))), 16, "0")

    return (rows.join(near, "fp", "left")
            .select("doc_id", "n_chars", "edited_sha256", shown("fp").alias("fingerprint"),
                    shown("edited_fp").alias("edited_fingerprint"), like("fp", "edited_fp").alias("near_edited"),
                    like("fp", "next_fp").alias("near_next"),
                    F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near")))


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.toxicity import fit, score_toxicity
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 5, 0)
    index = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score_toxicity(docs, index).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


@register("op2_lm_score")
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.lm import score_texts
    return score_texts(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2))


@register("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.pages import extract_main_text
    return extract_main_text(table(spark, sf_dir, "pages"))


@register("op13_shards")
def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.shards import LAW, read_shards, text_size, write_shards
    docs, path = table(spark, sf_dir, "documents"), work_path(spark, "shards")
    write_shards(docs, 8, path)
    return read_shards(spark, path, docs.schema).select(
        "doc_id", text_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.align import block_pairs, encoded, linked
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    blocks = encoded(table(spark, sf_dir, "documents"), *paths)
    return linked(blocks, block_pairs(blocks, *paths), *paths, digest=True)


#: All phrases counted in full; every longer phrase is asked whether it holds the shorter one.
_OP11_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
gram AS (
  SELECT lang, k, g, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
    FROM words, (VALUES (1), (2), (3), (4)) AS size(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
held AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(f) AS longer
  FROM (SELECT lang, k, f, string_split(g, ' ') AS w FROM gram WHERE k > 2),
    (VALUES (2), (3)) AS part(m), (VALUES (1), (2), (3)) AS place(i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT gram.*, string_split(g, ' ') AS w FROM gram LEFT JOIN held USING (lang, g)
  WHERE k > 1 AND coalesce(100 * longer < 80 * f, true)),
cut AS (
  SELECT kept.lang, kept.g, kept.f AS a, c, x.f AS l, y.f AS r,
    (2000000::HUGEINT * kept.f) // (x.f + y.f) AS score
  FROM kept, (VALUES (1), (2), (3)) AS cuts(c), gram x, gram y
  WHERE c < kept.k AND x.lang = kept.lang AND y.lang = kept.lang
    AND x.g = array_to_string(w[1:c], ' ') AND y.g = array_to_string(w[c + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@register("op11_collocations", _OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowlake.llm.phrases import collocations
    return collocations(table(spark, sf_dir, "documents"))
