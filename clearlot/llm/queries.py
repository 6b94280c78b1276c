"""The corpus operators as queries over the given tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearlot.llm import (
    byte_pairs,
    centroids,
    decontaminate,
    html_extract,
    jaccard_join,
    language_id,
    line_dedup,
    quality_rules,
    ranked_search,
    substring_dedup,
    suffix_dedup,
    token_files,
    url_filter,
)
from clearlot.llm.common import table
from clearlot.session import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded by the byte-level ranks."""
    return byte_pairs.round_trip_digests(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written as sequences and read back from the files."""
    place = fresh_folder(spark, "sequences")
    token_files.write_sequences(
        table(spark, folder, "documents"), place, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_files.document_checksums(spark, place)


#: The rules that op7 is given.
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@query
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with nine tenths of their three-word shingles in common."""
    return jaccard_join.similar_documents(table(spark, folder, "documents"), alike=(90, 100), shingle=3)


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of the benchmark."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the 50-byte strings that a document with a smaller id holds."""
    return suffix_dedup.digest(suffix_dedup.without_repeats(table(spark, folder, "documents")))


@query
def op5_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract_pages(table(spark, folder, "pages"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Page ids with the labels of the document that a page shows; the URL's path ends with that document's number."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"^/[^/]+/([0-9]{1,18})(?:/|\.html)?$", 1)
    shown = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    return shown.join(labels, "doc_id")


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for every page's URL; pages whose document is labelled teach the mined rules."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels").select("doc_id", F.when(bad, "block").when(~bad, "allow").alias("verdict"))
    taught = labelled_pages(pages, labels).select(F.col("page_id").alias("id"), "verdict")
    return url_filter.judge_urls(pages, taught, URL_RULES)


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = table(spark, folder, "documents")
    model = language_id.learn(docs.where(~language_id.held_out()))
    labelled = language_id.label_languages(docs, model, keep=("doc_id",))
    return labelled.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score",
                           F.size("spans").alias("n_spans"))


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the line-first rules for every document."""
    judged = quality_rules.clean_lines(table(spark, folder, "documents"))
    return judged.withColumn("n_clean_chars", F.length("clean_text")).drop("clean_text")


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without lines that repeat, exactly or with up to two edits, a line before."""
    cleaned = line_dedup.without_repeated_lines(table(spark, folder, "documents"))
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        F.size(gone).alias("n_removed"),
        gone.alias("removed"),
        "text",
    )


@query
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the 20-word windows that stand earlier."""
    return substring_dedup.digests(substring_dedup.without_repeated_passages(table(spark, folder, "documents")))


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster of every embedding after ten rounds around eight centroids."""
    return centroids.digests(centroids.cluster(table(spark, folder, "embeddings")))


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
