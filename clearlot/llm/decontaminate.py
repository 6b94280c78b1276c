"""Benchmark passages in documents, found by winnowing. DataFrame functions only.

Texts are words: runs of characters other than ASCII punctuation, spaces and controls, with A-Z in lower case. A window
is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window. A word of a
document is hit if it lies in an occurrence of a window.

Every run of ``GRAM`` words has a hash. Of each WINDOW - GRAM + 1 consecutive hashes the least is kept, the last of equal
ones, so that a document and an item that share a window keep the same hash at the same place in it. Kept hashes are
joined; a match is a place in the document at which to lay the item. There the item's words and the document's are
compared one by one, over the whole item, which extends the match to both sides and makes the result exact. Items shorter
than a window are matched by the hash of all of their words.

Null and empty texts have no words. Repeated documents get a row each; repeated items count once. Items without an id hit
words but are not listed. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import text_or_empty
from clearlot.session import staged

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: Up to this many rows the item's hashes, the items and the places found are broadcast; more are shuffled.
BROADCAST_ROWS = 200_000
#: The low bits of a kept hash hold the place of the run, counted backwards so that the last of equal hashes is least.
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1


def words_of(column: str = "text") -> Column:
    lower = F.translate(text_or_empty(column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORDS), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once for the row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _runs(hashes: Column, size: int) -> Column:
    """For each run of ``size`` words its hash and place in one number."""

    def packed(i: Column) -> Column:
        mixed = F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])
        place = F.lit(PLACES).cast("long") - i.cast("long").bitwiseAND(F.lit(PLACES).cast("long"))
        return mixed.bitwiseAND(F.lit(~PLACES)).bitwiseOR(place)

    starts = F.sequence(F.lit(0), F.size(hashes) - size)
    return F.when(F.size(hashes) >= size, F.transform(starts, packed)).otherwise(_empty())


def _kept(runs: Column, span: int) -> Column:
    """The least of each ``span`` consecutive runs."""
    starts = F.sequence(F.lit(0), F.size(runs) - span)
    least = F.transform(starts, lambda i: F.least(*[F.get(runs, i + j) for j in range(span)]))
    return F.when(F.size(runs) >= span, F.array_distinct(least)).otherwise(_empty())


def _places() -> tuple[Column, Column]:
    """Hash and place of a packed number."""
    low = F.lit(PLACES).cast("long")
    packed = F.col("print")
    place = (low - packed.bitwiseAND(low)).cast("int")
    return packed.bitwiseAND(F.lit(~PLACES)).alias("hash"), place.alias("place")


def _fingerprints(frame: DataFrame, keys: list[str], words: Column, window: int, gram: int) -> DataFrame:
    """Keys, hash and place of all kept runs of texts with a whole window."""
    kept = let(_hashes(words), lambda hashes: let(_runs(hashes, gram), lambda runs: _kept(runs, window - gram + 1)))
    return frame.select(*keys, F.explode(kept).alias("print")).select(*keys, *_places())


def _whole(frame: DataFrame, keys: list[str], words: Column, size: int) -> DataFrame:
    """Keys, hash and place of all runs of ``size`` words."""
    runs = let(_hashes(words), lambda hashes: _runs(hashes, size))
    return frame.select(*keys, F.explode(runs).alias("print")).select(*keys, *_places())


def _small(frame: DataFrame, limit: int) -> DataFrame:
    """The frame, to be broadcast if it has no more rows than ``limit``."""
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows ``id, digest, item, first, covered``: where an item lies in a document, and the covered places from there.

    ``digest`` tells texts with one id apart. ``covered`` are offsets from ``first`` on.
    """
    docs = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).withColumn(
        "digest", F.xxhash64("text")
    )
    held = staged(
        items.select(F.col(item_column).alias("item"), words_of(item_text).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .select("item", F.xxhash64("words").alias("which"), "words", F.size("words").alias("n_item")),
        "items",
    )
    own, keys = words_of("text"), ["id", "digest"]
    item_words, item_keys = F.col("words"), ["item", "which", "n_item"]
    long_items = held.where(F.col("n_item") >= window)
    pairs = [
        (_fingerprints(docs, keys, own, window, gram), _fingerprints(long_items, item_keys, item_words, window, gram))
    ]
    short = held.where(F.col("n_item") < window).select("n_item").distinct().collect()  # fewer rows than a window
    for size in sorted(row["n_item"] for row in short):
        these = held.where(F.col("n_item") == size)
        pairs.append((_whole(docs, keys, own, size), _whole(these, item_keys, item_words, size)))
    found = None
    for ours, theirs in pairs:
        theirs = _small(theirs.select(*item_keys, "hash", F.col("place").alias("at")), broadcast_rows)
        laid = ours.join(theirs, "hash").select(*keys, *item_keys, (F.col("place") - F.col("at")).alias("first"))
        found = laid if found is None else found.unionByName(laid)
    laid = staged(found.distinct(), "laid")
    by_doc = laid.groupBy(*keys).agg(F.collect_list(F.struct(*item_keys, "first")).alias("laid"))
    by_doc = _small(by_doc.withColumnsRenamed({"id": "its_id", "digest": "its_digest"}), broadcast_rows)

    def cut(words: Column) -> Column:
        """The part of the document below each item; in texts with more words than places, at all that are meant."""

        def part(one: Column, first: Column) -> Column:
            size = one["n_item"] + F.least(first, F.lit(0))
            return F.struct(
                one["item"].alias("item"),
                one["which"].alias("which"),
                first.alias("first"),
                F.slice(words, F.greatest(first, F.lit(0)) + 1, size).alias("part"),
            )

        def all_of(one: Column) -> Column:
            firsts = F.sequence(one["first"], F.greatest(one["first"], F.size(words) - 1), F.lit(PLACES + 1))
            return F.transform(firsts, lambda first: part(one, first))

        return F.flatten(F.transform(F.col("laid"), all_of))

    parts = (
        docs.join(by_doc, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest")))
        .select(*keys, F.explode(let(words_of("text"), cut)).alias("one"))
        .select(*keys, "one.*")
        .distinct()
    )
    theirs = _small(
        held.select(F.col("item").alias("its_item"), F.col("which").alias("its_which"), F.col("words").alias("item_words")),
        broadcast_rows,
    )
    start = F.greatest(-F.col("first"), F.lit(0))
    needs = F.least(F.lit(window), F.size("item_words"))
    beside = F.slice("item_words", start + 1, F.size("part"))

    def covered(same: Column) -> Column:
        """The places of all windows that are the same throughout."""
        starts = F.filter(
            F.sequence(F.lit(0), F.size(same) - needs),
            lambda i: F.forall(F.slice(same, i + 1, needs), lambda equal: equal),
        )
        places = F.flatten(F.transform(starts, lambda i: F.sequence(i, i + needs - 1)))
        return F.when(F.size(same) >= needs, F.array_distinct(places))

    return (
        parts.join(theirs, F.col("item").eqNullSafe(F.col("its_item")) & (F.col("which") == F.col("its_which")))
        .select(
            *keys,
            "item",
            (F.col("first") + start).alias("first"),
            let(F.zip_with("part", beside, lambda a, b: a.eqNullSafe(b)), covered).alias("covered"),
        )
        .where(F.size("covered") > 0)
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document ``n_words``, ``n_hit``, ``items`` (sorted ids as text) and ``contaminated``."""
    hits = staged(find_hits(docs, items, id_column, text_column, item_column, item_text, window, gram), "hits")
    keys = ["id", "digest"]
    words = (
        hits.select(*keys, F.explode("covered").alias("offset"), "first")
        .select(*keys, (F.col("first") + F.col("offset")).alias("place"))
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n_hit"))
    )
    listed = (
        hits.where(F.col("item").isNotNull())
        .select(*keys, F.col("item").cast("string").alias("item"))
        .distinct()
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    told = words.withColumnsRenamed({"id": "its_id", "digest": "its_digest"})
    named = listed.withColumnsRenamed({"id": "item_doc", "digest": "item_digest"})
    own = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).select(
        "id", F.xxhash64("text").alias("digest"), F.size(words_of("text")).cast("long").alias("n_words")
    )
    return (
        own.join(told, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest")), "left")
        .join(named, F.col("id").eqNullSafe(F.col("item_doc")) & (F.col("digest") == F.col("item_digest")), "left")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def without_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that no benchmark window occurs in, with all of their columns."""
    hit = find_hits(docs, items, id_column, text_column, item_column, item_text).select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest")
    ).distinct()
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(text_or_empty(text_column)) == F.col("__digest"))
    return docs.join(hit, same, "left_anti")
