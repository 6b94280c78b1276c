"""Documents whose word shingles are alike, by PartEnum signatures.

A document's set holds the hashes of its distinct shingles. Sets of similar sizes form a band; two sets whose similarity
reaches the threshold are in one band or in neighbouring ones, and differ in at most a known number of elements there.
For each band the feature domain is divided into groups and every group into ``PARTS`` partitions; there are so many
groups that of two such sets one group differs in at most ``TOLERATED`` elements. So all but so many of that group's
partitions are alike, and a signature for each group and each such choice of its partitions is shared. Sets emit the signatures of their own band and
of the band below.

Partitions that are empty in a set say nothing and give no signature. There are some groups more than needed (``SPARE``),
and a set with empty partitions in no more than these still has a group that counts. A set with more of them also emits
the signatures of another division of the domain, and so on; if that holds for one of two linked sets only, the other one
has found it. The last of ``LEVELS`` divisions emits empty ones, too, so no pair is lost.

Equal sets are one class, told by a 64-bit hash; only classes are compared. Sets that share a signature are candidates if
their parities, a bit for each of ``PARITIES`` cells of the domain, differ in no more places than linked sets can differ in
elements; candidates are verified by the sets themselves. Signatures are many times the rows, so they are written by their
leading bits into ``SLICES`` columns, and a step shuffles one of them. Documents without words, or text, have an empty set and are linked with nothing.
Repeated rows are members of one class; a row without an id is linked like any other, but names no component.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, in_python, schema_of, staged_small, text_or_empty
from clearlot.llm.linking import link_groups
from clearlot.session import staged, unstaged

#: Links: ALIKE[0] in ALIKE[1] of the union are common. Shingles are of so many words.
ALIKE = (80, 100)
SHINGLE = 5
PARTS, TOLERATED, LEVELS = 2, 1, 6
SPARE = 0.08
#: A multiple of 64.
PARITIES = 1024
#: Up to this many rows, a table of ids or keys is broadcast; more are shuffled.
BROADCAST_ROWS = 500_000
#: Equal signatures lie in one slice. Slices go together while they hold no more signatures than this.
SLICES = 8
SIGNS_AT_ONCE = 10_000_000
#: Pairs whose sets are compared go in up to SLICES slices, each of so many or more.
PAIRS_AT_ONCE = 5_000
WORDS_KEPT = 100_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * _B
    values = (values ^ (values >> np.uint64(27))) * _C
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes; word hashes are remembered."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.words: dict[bytes, int] = {}
        self.factors = mixed(np.arange(1, size + 1, dtype=np.uint64) * _A) | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; one for the whole text if it has fewer words, none if it has none."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > WORDS_KEPT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.array([known[word] for word in words], np.uint64)
        size = min(self.size, len(words))
        total = np.full(len(words) - size + 1, size, np.uint64)
        for at in range(size):
            total += hashes[at : len(words) - size + 1 + at] * self.factors[at]
        return np.unique(mixed(total))


def band_starts(alike: tuple[int, int], largest: int) -> list[int]:
    """The least size of each band; sizes of a band lie within the threshold's ratio."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * alike[1] // alike[0] + 1)
    return starts


class Signer:
    """PartEnum signatures of sets."""

    def __init__(self, alike: tuple[int, int] = ALIKE):
        self.alike = alike
        self.starts = [1]

    def _differ(self, band: int) -> int:
        """How many elements a set of the band and a set of it or of the next one can differ in and still be linked."""
        num, den = self.alike
        largest = self.starts[band + 1] - 1
        return (den - num) * (largest + largest * den // num) // (den + num)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return values
        if self.starts[-1] <= 2 * len(values):
            self.starts = band_starts(self.alike, 4 * len(values))
        band = int(np.searchsorted(self.starts, len(values), side="right")) - 1
        made = [self._band(values, which) for which in (band - 1, band) if which >= 0]
        return np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)

    def _band(self, values: np.ndarray, band: int) -> np.ndarray:
        differ = self._differ(band)
        if not differ:  # only equal sets, which are one class
            return np.zeros(0, np.uint64)
        needed = differ // (TOLERATED + 1) + 1
        spare = int(SPARE * needed) + 1
        groups = needed + spare
        made = []
        for level in range(LEVELS):
            salt = mixed(np.array([band * LEVELS + level + 1], np.uint64) * _A)[0]
            spread = mixed(values ^ salt)
            cell = (spread % np.uint64(groups)).astype(np.int64) * PARTS
            cell += ((spread >> np.uint64(40)) % np.uint64(PARTS)).astype(np.int64)
            counts = np.bincount(cell, minlength=groups * PARTS).reshape(groups, PARTS)
            sums = np.zeros(groups * PARTS, np.uint64)
            np.add.at(sums, cell, mixed(spread))
            sums = sums.reshape(groups, PARTS)
            number = np.arange(groups, dtype=np.uint64)
            idle = np.zeros(groups, bool)
            for which, chosen in enumerate(combinations(range(PARTS), PARTS - TOLERATED)):
                held = counts[:, chosen].sum(1) > 0
                signs = mixed(number * np.uint64(PARTS) + np.uint64(which)) + salt
                for part in chosen:
                    signs += sums[:, part] * (_A + np.uint64(2 * part))
                signs = mixed(signs)
                made.append(signs if level == LEVELS - 1 else signs[held])
                idle |= ~held
            if idle.sum() <= spare:
                break
        return np.concatenate(made)


def sliced(signs: np.ndarray) -> list[np.ndarray]:
    """Sorted signatures, as signed numbers, by their leading bits: one array for each slice."""
    starts = np.arange(1, SLICES, dtype=np.uint64) * np.uint64(2**64 // SLICES)
    return np.split(signs.view(np.int64), np.searchsorted(signs, starts))


def cells(values: np.ndarray) -> np.ndarray:
    """How many elements lie in each cell; more than 127 count as 127."""
    counts = np.bincount((mixed(values) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.minimum(counts, 127).astype(np.int8)


def parities(values: np.ndarray) -> list[int]:
    """Whether an odd number of elements lies in each cell, 64 cells in one number."""
    counts = np.bincount((mixed(values) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(counts.astype(np.uint8)).view(np.int64).tolist()


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def class_of(values: np.ndarray) -> int | None:
    return signed(xxhash.xxh3_64_intdigest(values.tobytes())) if len(values) else None


def _small(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def _sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``a, b, n_a, n_b, ours, theirs``: the pairs with the sizes and a column of their sets."""
    paired = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets.select("id", "size", column).join(_small(paired), "id", "left_semi")
    a = sets.select(F.col("id").alias("a"), F.col("size").alias("n_a"), F.col(column).alias("ours"))
    b = sets.select(F.col("id").alias("b"), F.col("size").alias("n_b"), F.col(column).alias("theirs"))
    return a.join(_small(pairs), "a").join(b, "b")


def _linked(pairs: DataFrame, sets: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold.

    Sets are wide, so only those meet whose sizes and numbers of elements in each cell allow it; cells of linked sets
    differ by no more elements than the sets do.
    """
    num, den = alike
    both = F.col("n_a") + F.col("n_b")
    sizes = (F.col("n_a") * den >= F.col("n_b") * num) & (F.col("n_b") * den >= F.col("n_a") * num)
    apart = F.zip_with("ours", "theirs", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    apart = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    close = _sides(pairs, sets, "cells").where(sizes).where(apart * (num + den) <= both * (den - num))
    close = staged(close.select("a", "b"), "close")
    common = F.size(F.array_intersect("ours", "theirs"))  # sets, so no element is there twice
    reached = common * den >= (both - common) * num
    steps = min(SLICES, close.count() // PAIRS_AT_ONCE + 1)
    found = []
    for step in range(steps):
        part = close if steps == 1 else close.where(F.pmod(F.xxhash64("a"), F.lit(steps)) == step)
        found.append(staged(_sides(part, sets, "shingles").where(reached).select("a", "b"), "reached"))
    return reduce(DataFrame.unionByName, found)


def similar_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    alike: tuple[int, int] = ALIKE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Per document ``n_shingles`` and ``component_id``, the least id that links reach from it; other columns are left out."""
    named = _classified(docs, id_column, text_column, alike, shingle)
    return named.select(F.col("id").alias(id_column), "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    alike: tuple[int, int] = ALIKE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """The rows of ``docs``, with all columns, of the first document of each component: least id, then least text hash.

    Rows without words stay. Of rows that repeat an id and a text one stays. Rows without an id come last: they stay if
    nothing with an id is in their component, one of each.
    """
    named = staged(_classified(docs, id_column, text_column, alike, shingle), "components")
    wordy = named.where(F.col("class").isNotNull())
    first = F.min(F.struct(F.col("id").isNull(), "id", "digest")).alias("first")
    rows = wordy.groupBy("root").agg(first, F.count("*").alias("n"))
    lost = (
        wordy.join(
            rows.where("n > 1").select("root", F.col("first.id").alias("keep_id"), F.col("first.digest").alias("keep_digest")),
            "root",
        )
        .where(~(F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("keep_digest"))))
        .select(F.col("id").alias("__id"), F.col("digest").alias("__digest"))
        .distinct()
    )
    text = text_or_empty(text_column)
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__digest"))
    left = docs.join(_small(staged(lost, "lost")), same, "left_anti")
    twice = wordy.groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1")
    twice = staged(twice.select(F.col("id").alias("__id"), F.col("digest").alias("__digest")), "twice")
    if twice.isEmpty():
        return left
    again = left.join(_small(twice), same, "left_semi").withColumn("__digest", F.xxhash64(text))
    return left.join(_small(twice), same, "left_anti").unionByName(
        again.dropDuplicates([id_column, "__digest"]).drop("__digest")
    )


def _members(held: DataFrame, slices: list[str]) -> DataFrame:
    """``key, id``: the signatures that several classes share, and these classes."""
    total = held.agg(F.sum("n_signs")).first()[0] or 0
    steps = min(len(slices), total // SIGNS_AT_ONCE + 1)
    found = []
    for step in range(steps):
        names = slices[len(slices) * step // steps : len(slices) * (step + 1) // steps]
        signs = held.select("class", F.explode(F.concat(*names)).alias("key"))
        ends = signs.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
        shared = staged(ends.where("low < high").select("key"), "shared")
        members = signs.join(_small(shared), "key").select("key", F.col("class").alias("id")).distinct()
        found.append(staged(members, "shares"))
    return reduce(DataFrame.unionByName, found)


def _classified(
    docs: DataFrame, id_column: str, text_column: str, alike: tuple[int, int], shingle: int
) -> DataFrame:
    """``id, digest, n_shingles, class, root, component_id`` of every row; ``root`` names the component by a class."""
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def start():
        shingles, signer = Shingler(shingle), Signer(alike)

        def row(key, text, digest) -> tuple:
            values = shingles(text)
            signs = signer(values)
            return key, digest, len(values), class_of(values), len(signs), *sliced(signs)

        return row

    slices = [f"signs{at}" for at in range(SLICES)]
    schema = schema_of(
        id_field(own, "id"),
        "digest long",
        "n_shingles long",
        "class long",
        "n_signs long",
        *(f"{name} array<long>" for name in slices),
    )
    hashed = own.withColumn("digest", F.xxhash64(text_or_empty("text")))
    held = staged_small(in_python(hashed, schema, start, measure=1), "signatures")
    holder = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest")).alias("holder")
    members = _members(held, slices)
    signed_rows, held = held, staged(held.drop("n_signs", *slices), "classes")
    unstaged(signed_rows)
    classes = held.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("id"), holder)
    wanted = members.select(F.col("id").alias("class")).distinct().join(classes, "class")
    wanted = staged(wanted.select("class", F.col("holder.id").alias("its_id"), F.col("holder.digest").alias("its_digest")), "wanted")

    def again():
        shingles = Shingler(shingle)

        def row(key, text) -> tuple:
            values = shingles(text)
            return class_of(values), len(values), parities(values), cells(values), values.view(np.int64)

        return row

    # one row of each class gives its set; the class found again tells texts of one hash
    its = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    texts = hashed.join(_small(wanted.select("its_id", "its_digest").distinct()), its, "left_semi").select("id", "text")
    schema = schema_of("id long", "size long", "parity array<long>", "cells array<tinyint>", "shingles array<long>")
    sets = staged_small(
        in_python(texts, schema, again, measure=1)
        .join(wanted.select(F.col("class").alias("id")), "id", "left_semi")
        .dropDuplicates(["id"]),
        "sets",
    )
    words = [F.col("parity")[at].alias(f"parity{at}") for at in range(PARITIES // 64)]
    traits = sets.select("id", "size", *words)

    def near(one: DataFrame, other: DataFrame) -> Column:
        differ = [
            F.bit_count(F.col(f"one.parity{at}").bitwiseXOR(F.col(f"other.parity{at}"))) for at in range(len(words))
        ]
        size = F.col("one.size") + F.col("other.size")
        return reduce(lambda a, b: a + b, differ) * (alike[0] + alike[1]) <= size * (alike[1] - alike[0])

    roots = link_groups(members, lambda pairs: _linked(pairs, sets, alike), near, staged(traits, "traits"))
    unstaged(sets)
    # a component's number is its least document id
    named = (
        classes.withColumnRenamed("id", "least")
        .join(roots.withColumnRenamed("id", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    numbers = named.groupBy("root").agg(F.min("least").alias("component_id"))
    numbered = named.join(numbers, "root").select("class", "root", "component_id")
    return held.join(numbered, "class", "left").select(
        "id",
        "digest",
        "n_shingles",
        "class",
        "root",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
