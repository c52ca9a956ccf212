"""Corpus pipeline: language ID, near-dedup, decontamination, PII masking, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``.

Defined cases (in any stage): an empty table stays empty with its columns; extra
columns are carried; null texts are rejected by the first stage (no letter); rows
with the same doc_id are judged by their own text, and of near-duplicate rows
with one doc_id a single one stays.

``run(spark, sf_dir)`` applies all stages to ``documents``.  ORACLE_SQL is None:
Viterbi labels, the Markov field and BPE are beyond SQL; ``tests/llm`` holds the
stages against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.bpe import encode_documents
from flowlake.llm.common import table, written
from flowlake.llm.decontam import without_leaks
from flowlake.llm.langid import accepted, fit
from flowlake.llm.neardup import without_near_duplicates
from flowlake.llm.pii import mask_personal_data


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose language is known; learns from the rows' own text and lang."""
    return accepted(docs, fit(docs, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group (five-word shingles, similarity 0.8 or more)."""
    return without_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, re-parameterised or not."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the text; n_chars follows the new text."""
    masked = mask_personal_data(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("encoding", encoding)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
