"""A training corpus in five stages; every stage works on all that the stage before it kept.

* ``language``: documents whose language cannot be told go, and those of which no language labels half of the letters.
* ``lines``: lines that repeat, exactly or with up to two edits, a line before are cut out; documents that consist of such
  lines go.
* ``near_duplicates``: of documents linked by four fifths of their five-word shingles the first stays.
* ``decontaminate``: documents that hold a window of ten words of a benchmark item, or a whole shorter item, go.
* ``tokens``: the token ids of every document, with digests of ids and decoded bytes.

Null columns, empty and long texts, repeated rows and empty tables are handled as the operators' modules say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearlot.llm import byte_pairs, decontaminate, jaccard_join, language_id, line_dedup
from clearlot.llm.common import DOCUMENT_COLUMNS, table
from clearlot.session import staged

#: A document stays if its language labels at least this share of its letters.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    model = language_id.learn(docs.where(~language_id.held_out()))
    labelled = language_id.label_languages(docs, model, keep=DOCUMENT_COLUMNS)
    told = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return labelled.where(told).select(*DOCUMENT_COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    cleaned = line_dedup.without_repeated_lines(docs)
    changed = F.col("removed").isNotNull()
    kept = cleaned.where(~changed | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    return kept.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard_join.one_of_each(docs).select(*DOCUMENT_COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, folder, "benchmark")).select(*DOCUMENT_COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return byte_pairs.round_trip_digests(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", without_benchmark),
    ("tokens", tokens),
]
#: SQL cannot express the first stage; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The stages applied to ``documents``; what a stage keeps is written before the next one reads it."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
