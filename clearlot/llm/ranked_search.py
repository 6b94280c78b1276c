"""The best documents for each of many queries, term at a time with a limit on accumulators.

Documents are read once: of each only its length and the counts of terms that some query holds are written down. Counts over
all documents give the weights. Then every task goes through blocks of documents. In a block each query takes its terms from
the rarest to the most frequent; a document that holds one gets an accumulator. As soon as all terms to come could not lift
a document without one to the score of the last place, no more are made, and only those that exist are carried on, with
exact sums. The last place is that of the block so far or of the blocks the task has done, whichever is higher. Each
task hands on the best of each query, and the best of these are the result.

* Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z become small. Null and empty texts,
  and texts without a term, count for nothing and are never found. Texts are taken whole.
* Repeated rows of documents are documents of their own. A query that stands several times, id and text alike, is answered
  once; different texts with one id are queries of their own. Documents without an id come last among equal scores.
* Queries without a term that stands in a document have no rows; an empty table of queries or documents gives none at all.
* Extra columns are not read.

Queries travel to the tasks in blocks of about ``QUERY_BYTES`` of text, however many there are, and each block of them
passes over the documents once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, schema_of
from clearlot.session import staged

#: Bytes of text of the queries that are answered in one pass over the documents, and documents of a block.
QUERY_BYTES, BLOCK = 8_000_000, 8_192

_FOLD = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or chr(code).isalnum() else 32 for code in range(256)
)
_DOCUMENTS, _LENGTH = -1, -2


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z as small letters."""
    return (text or b"").translate(_FOLD).split()


def _postings(docs: DataFrame, numbers: dict[bytes, int], text: str, key: str) -> DataFrame:
    """``id, length, terms, counts`` of every document with a term; the lists hold terms of ``numbers`` only."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                lengths, found, counts = [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    counted = Counter(terms(text))
                    held = [(known[term], count) for term, count in counted.items() if term in known]
                    lengths.append(counted.total())
                    found.append([number for number, _ in held])
                    counts.append([count for _, count in held])
                made = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int64()))],
                    names=["id", "length", "terms", "counts"],
                )
                yield made.filter(pa.array([length > 0 for length in lengths], pa.bool_()))

    schema = schema_of(id_field(rows, "id"), "length long", "terms array<int>", "counts array<long>")
    return rows.mapInArrow(task, schema)


def _statistics(postings: DataFrame, size: int) -> dict[int, int]:
    """Documents that hold a term, by its number; and under two numbers below 0 all documents and all their terms."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        documents = length = 0
        for batch in batches:
            documents += batch.num_rows
            length += sum(batch.column(0).to_pylist())
            held += np.bincount(batch.column(1).flatten().to_numpy(zero_copy_only=False), minlength=size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({
            "number": pa.array([_DOCUMENTS, _LENGTH, *used.tolist()], pa.int32()),
            "n": pa.array([documents, length, *held[used].tolist()], pa.int64()),
        })

    parts = postings.select("length", "terms").mapInArrow(task, schema_of("number int", "n long"))
    return {row.number: int(row.n) for row in parts.groupBy("number").agg(F.sum("n").alias("n")).collect()}


class Block:
    """Some documents, as lists of holders and impacts for each term."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, documents: int, length: int) -> None:
        lengths = batch.column(1).to_pylist()
        norms = np.array([100 - 25 + (25 * one * documents) // length for one in lengths], np.int64)
        numbers = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        counts = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        owners = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
        order = np.argsort(numbers, kind="stable")
        self.size = batch.num_rows
        self.holders = owners[order]
        numbers, counts = numbers[order], counts[order]
        self.impacts = weights[numbers] * ((1_000_000_000 * counts) // (1000 * counts + 12 * norms[self.holders]))
        self.edges = np.searchsorted(numbers, np.arange(len(weights) + 1))
        filled = np.flatnonzero(np.diff(self.edges))
        self.most = np.zeros(len(weights), np.int64)
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.impacts, self.edges[filled])

    def postings(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.edges[number], self.edges[number + 1])
        return self.holders[part], self.impacts[part]


def scores(block: Block, query: list[tuple[int, int]], places: int, floor: int) -> np.ndarray:
    """Accumulators of the block's documents; exact for all that can get one of the places, and 0 or less for others.

    ``query`` has numbers and repeats of its terms, rarest first. Scores below ``floor`` are of no use to the caller.
    """
    bounds = [int(block.most[number]) * repeats for number, repeats in query]
    rest = sum(bounds)
    reached = 0
    sums = np.zeros(block.size, np.int64)
    living = None
    for (number, repeats), bound in zip(query, bounds, strict=True):
        if living is None:
            last = floor
            if floor <= rest < reached:  # else even the best so far can't be above all that is to come
                last = max(floor, int(np.partition(sums, -places)[-places])) if block.size >= places else floor
            if rest < last:
                living = sums > 0
                if not living.any():
                    break
        holders, impacts = block.postings(number)
        if living is not None:
            kept = living[holders]
            holders, impacts = holders[kept], impacts[kept]
        sums[holders] += impacts * repeats
        rest -= bound
        reached += bound
    return sums


def _search(
    postings: DataFrame, queries: list[list[tuple[int, int]]], weights: np.ndarray, counted: dict[int, int], places: int
) -> DataFrame:
    """``query, id, score``: the best documents that each task finds for each query."""
    documents, length = counted[_DOCUMENTS], counted[_LENGTH]
    shared = postings.sparkSession.sparkContext.broadcast((queries, weights))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        best: list[list[tuple[int, bool, object]]] = [[] for _ in asked]  # ascending by what comes last
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([column.slice(start, BLOCK)]) for column in batch.columns], schema=batch.schema
                )
                block = Block(part, weight, documents, length)
                ids = part.column(0)
                for at, query in enumerate(asked):
                    before = best[at]
                    floor = -before[-1][0] if len(before) == places else 0
                    sums = scores(block, query, places, floor)
                    found = np.flatnonzero(sums >= max(floor, 1))
                    if len(found) > places:  # those tied with the last place stay too
                        found = found[sums[found] >= np.partition(sums[found], -places)[-places]]
                    new = [(-int(sums[row]), ids[int(row)].as_py()) for row in found]
                    merged = before + [(score, one is None, one) for score, one in new]
                    best[at] = sorted(merged, key=lambda one: (one[0], one[1], 0 if one[1] else one[2]))[:places]
        rows = [(at, one[2], -one[0]) for at, kept in enumerate(best) for one in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[0] for row in rows], pa.int32()),
             pa.array([row[1] for row in rows], arrow_id),
             pa.array([row[2] for row in rows], pa.int64())],
            names=["query", "id", "score"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(postings.schema["id"].dataType)
    return postings.mapInArrow(task, schema_of("query int", id_field(postings, "id"), "score long"))


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[object, bytes]]]:
    """Ids and texts of the distinct queries, a bounded part at a time."""
    rows = items.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text")).distinct()
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(1, math.ceil(size / QUERY_BYTES))
    for part in range(parts):
        chosen = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield [(row.id, bytes(row.text or b"")) for row in chosen.collect()]


def _answer(
    spark: SparkSession, docs: DataFrame, asked: list[tuple[object, bytes]], places: int, keys: tuple[str, str, str]
) -> DataFrame | None:
    """The rows for a bounded part of the queries, or None if they have no terms."""
    text, key, kind = keys
    counted_terms = [Counter(terms(one)) for _, one in asked]
    numbers = {term: number for number, term in enumerate(sorted(set().union(*counted_terms)))}
    if not numbers:
        return None
    postings = staged(_postings(docs, numbers, text, key), "postings")
    counted = _statistics(postings, len(numbers))
    documents = counted.get(_DOCUMENTS, 0)
    held = np.array([counted.get(number, 0) for number in range(len(numbers))], np.int64)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
    queries = [
        sorted(((numbers[term], n) for term, n in one.items() if held[numbers[term]]), key=lambda pair: (held[pair[0]], pair[0]))
        for one in counted_terms
    ]
    found = _search(postings, queries, weights, counted, places)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ranked = staged(found.withColumn("rank", place).where(F.col("rank") <= places), "ranked")
    # as many rows as the bounded part has queries
    names = spark.createDataFrame([(at, one) for at, (one, _) in enumerate(asked)], schema_of("query int", f"item {kind}"))
    return ranked.join(F.broadcast(names), "query").select("item", "rank", "id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    places: int = 20,
    text: str = "text",
    key: str = "doc_id",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``places`` best documents of each query: ``item_key``, rank, ``key``, score."""
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType.simpleString()
    answers = [_answer(spark, docs, asked, places, (text, key, kind)) for asked in _blocks(items, item_key, item_text)]
    answers = [one for one in answers if one is not None]
    if not answers:
        answers = [spark.createDataFrame([], schema_of(f"item {kind}", "rank int", id_field(docs.select(F.col(key).alias("id")), "id"), "score long"))]
    return reduce(DataFrame.unionByName, answers).toDF(item_key, "rank", key, "score")
