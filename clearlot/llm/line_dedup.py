"""Repeated lines, exact or with few edits, by a segment-partition edit join.

Lines are ``\\n``-split and compared without the white space at their ends. Equal lines are linked whatever their length;
lines of nothing but white space separate others and are never compared. Two lines of at least ``MIN_CHARS`` characters
are also linked if at most ``EDITS`` insertions, deletions or substitutions of characters lead from one to the other:
among shorter ones few edits lead from a word to quite another.

A line is cut into EDITS + 1 segments of even length; a line within that many edits holds one of them unchanged, shifted
by few places. So every line is indexed by its segments, with their number and the line's length, and probes, for its own
length and each length up to EDITS below, the substrings that can be such a segment: those whose shift agrees with the
edits that may lie before and after them. Lines that meet there are candidates unless their
character pairs differ by more than the edits can change; candidates are verified by an edit distance computed
along the diagonal, a band of 2 * EDITS + 1 cells in the bits of one integer.

Linked lines form groups. Of each group the first line is kept, in the order of document ids and lines, and all others
are removed; equal lines are one line. What is a copy is judged on the input. A null text has no lines, an empty one a single
empty line, which is never compared. Rows with the same id and text are one document: they lose the same lines. Rows without an id come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import schema_of, staged_small, text_or_empty, then_given_back
from clearlot.llm.linking import link_groups
from clearlot.session import staged

EDITS = 2
#: Lines from this length on are linked by edits too; equal ones always are.
MIN_CHARS = 20
#: Up to this many rows, keys, lines or documents are broadcast; more are shuffled.
BROADCAST_ROWS = 500_000
ROWS_AT_ONCE = 100_000
#: Lines that a task remembers, so as not to make the keys of a repeated one again.
LINES_KEPT = 200_000
#: Cells for pairs of neighbouring characters, a multiple of 64. An edit takes away and adds four pairs at most.
PARITIES = 256
PAIRS_OF_AN_EDIT = 4


def line_id(line: str) -> int:
    """A hash of 63 bits, the lowest left free."""
    value = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) & ~1
    return value - (1 << 64) if value >> 63 else value


def segment(length: int, number: int, edits: int = EDITS) -> tuple[int, int]:
    """Start and size of a segment of a line."""
    start = length * number // (edits + 1)
    return start, length * (number + 1) // (edits + 1) - start


#: Bytes of a character in the coding whose slices are hashed.
WIDTH = 4


@lru_cache(maxsize=4096)
def _cuts(count: int, edits: int, min_chars: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """For lines of ``count`` characters: first and last byte and seed of each substring, and 1 for those of the index."""
    cuts, own = [], []
    for less in range(edits + 1):
        length = count - less
        if length < min_chars:
            break
        for number in range(edits + 1):
            at, size = segment(length, number, edits)
            first = max(at - number, at + less - (edits - number), 0)
            last = min(at + number, at + less + (edits - number), count - size)
            for start in range(first, last + 1):
                cuts.append((start * WIDTH, (start + size) * WIDTH, length * (edits + 1) + number))
                own.append(int(not less and start == at))
    return cuts, own


def line_keys(line: str, edits: int = EDITS, min_chars: int = MIN_CHARS) -> tuple[list[int], list[int]]:
    """Hashes of the substrings a line is found by, and 1 for those it is indexed by, else 0."""
    cuts, own = _cuts(len(line), edits, min_chars)
    coded, digest = line.encode("utf-32-le", "surrogatepass"), xxhash.xxh3_64_intdigest
    return [digest(coded[first:last], seed) for first, last, seed in cuts], own


def within(one: str, other: str, edits: int = EDITS) -> bool:
    """Whether at most ``edits`` edits lead from one text to the other."""
    pattern, text = sorted((one, other), key=len)
    m, n = len(pattern), len(text)
    if n - m > edits:
        return False
    masks: dict[str, int] = {}
    for at, char in enumerate(pattern, 1):
        masks[char] = masks.get(char, 0) | 1 << (at + edits)
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    # bit b of column j stands for row j - edits + b; rows from 1 on are one more than the row above in column 0
    plus, minus = full & ~((1 << edits) - 1), 0
    distance, limit = min(edits, m), 2 * edits + n - m
    for j in range(1, n + 1):
        match = (masks.get(text[j - 1], 0) >> j) & full
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        right_plus = minus | (full & ~(diagonal | plus))
        right_minus = diagonal & plus & full
        if j + edits <= m:  # down the lower edge of the band
            if not diagonal & top:
                distance += 1
                if distance > limit:
                    return False
        else:  # along the last row
            bit = 1 << (m - j + edits)
            if right_plus & bit:
                distance += 1
            elif right_minus & bit:
                distance -= 1
        below = (diagonal & full) >> 1
        plus = right_minus | (full & ~(below | right_plus))
        minus = below & right_plus
    return distance <= edits


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    own = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return own.withColumn("digest", F.xxhash64("text"))


def _lines(own: DataFrame) -> DataFrame:
    """Where lines stand: ``id, digest, number, line`` for all lines that are not empty."""

    schema = schema_of(f"id {own.schema['id'].dataType.simpleString()}", "digest long", "numbers array<int>", "lines array<long>")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            numbers, lines = [], []
            for text in batch.column(1).to_pylist():
                found = [(at, line_id(cut)) for at, line in enumerate(text.split("\n")) if (cut := line.strip())]
                numbers.append([at for at, _ in found])
                lines.append([line for _, line in found])
            columns = [batch.column(0), batch.column(2), pa.array(numbers, pa.list_(pa.int32())), pa.array(lines, pa.list_(pa.int64()))]
            columns = [column.cast(field.type) for column, field in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return (
        own.select("id", "text", "digest")
        .mapInArrow(lambda batches: then_given_back(task(batches)), schema)
        .select("id", "digest", F.explode(F.arrays_zip("numbers", "lines")).alias("one"))
        .select("id", "digest", F.col("one.numbers").alias("number"), F.col("one.lines").alias("line"))
    )


def _keys(own: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``key, line``: the substrings that lines are found by; the lowest bit of the line tells if it is indexed by it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        lines: list[int] = []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(lines, np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["key", "line"])

        seen: set[int] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in text.split("\n"):
                    cut = line.strip()
                    if len(cut) >= min_chars and (number := line_id(cut)) not in seen:
                        if len(seen) >= LINES_KEPT:
                            seen.clear()
                        seen.add(number)
                        found, owned = line_keys(cut, edits, min_chars)
                        keys += found
                        lines += [number | flag for flag in owned]
                if len(keys) >= ROWS_AT_ONCE:
                    yield packed()
                    keys, lines = [], []
        if keys:
            yield packed()

    return own.select("text").mapInArrow(lambda batches: then_given_back(task(batches)), schema_of("key long", "line long"))


def parities(line: str) -> list[int]:
    """Whether an odd number of character pairs lies in each cell, 64 cells in one number."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    cells = (codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0x94D049BB133111EB)) >> np.uint64(40)
    odd = np.bincount((cells % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _texts(own: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """``id, chars, parity, text`` of the wanted lines (``line, id, digest, number``: one place of each)."""
    numbers = wanted.groupBy("id", "digest").agg(F.collect_list("number").alias("numbers"))
    numbers = _small(numbers.withColumnsRenamed({"id": "its_id", "digest": "its_digest"}))
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    schema = schema_of("id long", "chars int", "parity array<long>", "text string")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            made = []
            for text, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = text.split("\n")
                for number in chosen:
                    line = lines[number].strip()
                    made.append((line_id(line), len(line), parities(line), line))
            for start in range(0, len(made), 10_000):
                columns = zip(*made[start : start + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), f.type) for v, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return own.join(numbers, same).select("text", "numbers").mapInArrow(lambda batches: then_given_back(task(batches)), schema).dropDuplicates(["id"])


def _small(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    schema = schema_of("a long", "b long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            keep = [within(one, other, edits) for one, other in texts]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = texts.select(F.col("id").alias("a"), F.col("text").alias("one"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("other"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "one", "other").mapInArrow(lambda batches: then_given_back(task(batches)), schema)


def removed_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``id, digest, removed``: the numbers, from 0, of the lines that each document loses; only documents that lose some."""
    own = _documents(docs, id_column, text_column)
    lines = staged_small(_lines(own), "lines")
    place = F.struct("id", "digest", "number")
    firsts = lines.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    found = _keys(own, edits, min_chars)
    bare = F.col("line").bitwiseAND(F.lit(~1))
    shared = staged_small(
        found.groupBy("key")
        .agg(F.min("line").alias("low"), F.max("line").alias("high"))
        .where(F.col("low").bitwiseAND(F.lit(~1)) != F.col("high").bitwiseAND(F.lit(~1)))
        .select("key"),
        "shared",
    )
    met = found.join(_small(shared), "key").groupBy("key", bare.alias("id")).agg(F.max(F.col("line").bitwiseAND(F.lit(1))).alias("own"))
    met = staged_small(met, "met")
    indexed = met.groupBy("key").agg(F.max("own").alias("any")).where(F.col("any") == 1).select("key")
    wanted = firsts.join(met.select(F.col("id").alias("line")).distinct(), "line", "left_semi").select("line", "first.*")
    texts = staged_small(_texts(own, wanted, min_chars), "texts")
    words = [F.col("parity")[at].alias(f"parity{at}") for at in range(PARITIES // 64)]
    members = staged(met.join(indexed, "key", "left_semi").select("key", "id").join(texts.select("id", "chars", *words), "id"), "members")

    def near(one: DataFrame, other: DataFrame) -> Column:
        differ = [
            F.bit_count(F.col(f"one.parity{at}").bitwiseXOR(F.col(f"other.parity{at}"))) for at in range(len(words))
        ]
        close = F.abs(F.col("one.chars") - F.col("other.chars")) <= edits
        return close & (reduce(lambda a, b: a + b, differ) <= PAIRS_OF_AN_EDIT * edits)

    roots = link_groups(members, lambda pairs: _verified(pairs, texts, edits), near).withColumnRenamed("id", "line")
    joined = roots.select("line", "root").unionByName(roots.select(F.col("root").alias("line"), "root").distinct())
    grouped = firsts.join(joined, "line")
    first_of = grouped.groupBy("root").agg(F.min("first").alias("keep"))
    linked = grouped.join(first_of, "root").select("line", "keep")
    repeated = firsts.where(F.col("first") != F.col("last")).select("line", F.col("first").alias("own"))
    kept = repeated.join(linked, "line", "full_outer").select("line", F.coalesce("keep", "own").alias("keep"))
    return (
        lines.join(kept, "line")
        .where(~place.eqNullSafe(F.col("keep")))
        .select("id", "digest", "number")
        .distinct()
        .groupBy("id", "digest")
        .agg(F.array_sort(F.collect_list("number")).alias("removed"))
    )


def without_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with its columns, the text without its repeated lines, ``n_lines`` and ``removed``.

    ``n_lines`` is the number of lines before, ``removed`` are the numbers of the lines that are gone, or null.
    """
    gone = staged(removed_lines(docs, id_column, text_column, edits, min_chars), "removed")
    gone = _small(gone.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("removed").alias("__removed")))
    text = text_or_empty(text_column)
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__digest"))
    left = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains("__removed", at)), "\n"
    )
    cleaned = F.when(F.col("__removed").isNull(), F.col(text_column)).otherwise(left)
    counted = F.when(F.col(text_column).isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    joined = docs.drop("removed", "n_lines").join(gone, same, "left").withColumn("n_lines", counted)
    named = joined.withColumn(text_column, cleaned).withColumn("removed", F.col("__removed"))
    return named.drop("__id", "__digest", "__removed")
