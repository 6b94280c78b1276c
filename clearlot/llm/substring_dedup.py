"""Word passages that stand earlier already, found through anchors at the positions of a difference cover.

A difference cover of a period holds, for every distance, two positions that far apart. So of two equal passages, wherever
they lie in their documents, some aligned pair of places within one period is at cover positions of both. Only the short
windows that begin there, the anchors, are hashed and compared. An anchor that stands twice is extended to both sides, to all
windows of full length that hold it; equal windows then go to the earliest of them, whole.

* Words are runs of characters other than space and the controls 9 to 13; null and empty texts, and texts of white space
  alone, have none. Texts are taken whole, whatever their length.
* Documents are ordered by id, those without one last. Different rows with one id are documents of their own, ordered by a
  hash of the row; repeated rows, id and text alike, are one document that stands several times, and none of them loses
  words to the other.
* Extra columns are not read. An empty table gives an empty result.
* Anchors are 64-bit hashes, of which false meetings only cost time; windows are compared by 96 bits of hash, and rows are
  told apart by 64 bits.

No group is ever gathered: anchors and windows are counted and reduced to their least with partial aggregation, and what
comes back to a document is no more than its own positions. Each step that several others need is written once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, schema_of
from clearlot.session import staged

#: For each period a smallest cover, whose differences give every distance once.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Bytes of text that are worked on at once; longer texts are cut between words for hashing.
CHUNK = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20)
_LETTERS = _RANDOM.integers(0, 1 << 64, (2, 256), np.uint64)
_BASES = _RANDOM.integers(0, 1 << 63, 2).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(0, 1 << 63, (2, 4096)).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    return max(period for period in COVERS if window - period + 1 >= max(1, window // 3))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(29))


def _powers(base: int, reach: int) -> np.ndarray:
    steps = np.full(reach + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the intervals."""
    change = np.bincount(begins, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


class Hasher:
    """Word boundaries and two 64-bit hashes of every word, for pieces of text."""

    def __init__(self) -> None:
        self.powers = self.inverse = np.ones((2, 1), np.uint64)

    def _ready(self, size: int) -> None:
        if size >= self.powers.shape[1]:
            reach = max(size, CHUNK)
            self.powers = np.array([_powers(base, reach) for base in _BASES])
            self.inverse = np.array([_powers(pow(int(base), -1, 1 << 64), reach) for base in _BASES])

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        blank = np.concatenate([[True], _BLANK[data], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[0::2], edges[1::2]
        self._ready(len(data))
        lanes = np.empty((2, len(starts)), np.uint64)
        for lane in range(2):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_LETTERS[lane][data] * self.powers[lane, : len(data)], out=sums[1:])
            lanes[lane] = _mixed((sums[ends] - sums[starts]) * self.inverse[lane, starts])
        return starts, ends, lanes

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start of every word and its hashes, a row for each lane."""
        data = np.frombuffer(text, np.uint8)
        places, lanes, begin = [], [], 0
        while begin < len(data):
            end = min(begin + CHUNK, len(data))
            while end < len(data) and not _BLANK[data[end]]:  # not within a word
                blanks = np.flatnonzero(_BLANK[data[end : end + CHUNK]])
                end = end + int(blanks[0]) if len(blanks) else min(end + CHUNK, len(data))
            starts, _, hashes = self._piece(data[begin:end])
            places.append(starts + begin)
            lanes.append(hashes)
            begin = end
        if not places:
            return np.zeros(0, np.int64), np.zeros((2, 0), np.uint64)
        return np.concatenate(places), np.concatenate(lanes, axis=1)


class Chunk:
    """Some texts with their words, numbered through."""

    def __init__(self, hasher: Hasher, texts: list[bytes]) -> None:
        starts, self.lanes = hasher.words(b"\n".join(texts))
        sizes = np.array([len(text) + 1 for text in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(starts, offsets)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.at = np.arange(len(starts)) - self.first[self.text]

    def begins(self, size: int) -> np.ndarray:
        """Whether a window of ``size`` words of one text begins at a word."""
        return self.at + size <= self.count[self.text]

    def windows(self, begins: np.ndarray, size: int, lane: int) -> np.ndarray:
        hashes = np.zeros(len(begins), np.uint64)
        for place in range(size):
            hashes += self.lanes[lane][begins + place] * _PLACES[lane, place]
        return _mixed(hashes)


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about CHUNK bytes of text in ``column``, and these texts."""
    for batch in batches:
        texts = [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]
        begin = size = 0
        for at, text in enumerate(texts):
            size += len(text) + 1
            if size >= CHUNK or at + 1 == len(texts):
                yield batch.slice(begin, at + 1 - begin), texts[begin : at + 1]
                begin, size = at + 1, 0


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of all elements of a column of lists; null lists are empty."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), counts), column.flatten().to_numpy(zero_copy_only=False)


def _numbered(frame: DataFrame, text: str, key: str) -> DataFrame:
    """``id, row, text``: the rows with a hash that tells them apart."""
    return frame.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.col(text).alias("text"))


def _anchors(rows: DataFrame, window: int, placed: bool) -> DataFrame:
    """``hash`` of every anchor, with ``row`` and place ``at`` if ``placed``."""
    period = period_for(window)
    size = window - period + 1
    cover = np.isin(np.arange(period), COVERS[period])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, texts in _chunks(batches, 0):
            chunk = Chunk(hasher, texts)
            chosen = np.flatnonzero(chunk.begins(size) & (chunk.count >= window)[chunk.text] & cover[chunk.at % period])
            columns = {"hash": chunk.windows(chosen, size, 0).view(np.int64)}
            if placed:
                columns["row"] = batch.column(1).to_numpy(zero_copy_only=False)[chunk.text[chosen]]
                columns["at"] = chunk.at[chosen].astype(np.int32)
            yield pa.RecordBatch.from_pydict(columns)

    if placed:
        return rows.select("text", "row").mapInArrow(task, schema_of("hash long", "row long", "at int"))
    return rows.select("text").mapInArrow(task, schema_of("hash long"))


def _near(chunk: Chunk, marks: pa.Array, window: int) -> np.ndarray:
    """The words of a chunk at which a window begins that holds a marked anchor."""
    period = period_for(window)
    texts, at = _lists(marks)
    word = chunk.first[texts] + at
    held = _covered(np.maximum(word - period + 1, chunk.first[texts]), word + 1, len(chunk.at))
    return np.flatnonzero(held & chunk.begins(window))


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """``one, two, id, row, at``: hashes and place of every window that holds a marked anchor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, texts in _chunks(batches, 2):
            chunk = Chunk(hasher, texts)
            begins = _near(chunk, batch.column(3), window)
            owner = pa.array(chunk.text[begins])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk.windows(begins, window, 0).view(np.int64)),
                    pa.array((chunk.windows(begins, window, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(chunk.at[begins].astype(np.int32)),
                ],
                names=["one", "two", "id", "row", "at"],
            )

    schema = schema_of("one long", "two int", id_field(rows, "id"), "row long", "at int")
    return rows.select("id", "row", "text", "marks").mapInArrow(task, schema)


def _without(rows: DataFrame, window: int) -> DataFrame:
    """The rows with what is left of them when windows with marks that are not first are taken away."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, texts in _chunks(batches, 1):
            chunk = Chunk(hasher, texts)
            again = np.zeros(len(chunk.at), bool)
            again[_near(chunk, batch.column(2), window)] = True
            owner, at = _lists(batch.column(3))
            again[chunk.first[owner] + at] = False
            begins = np.flatnonzero(again)
            gone = _covered(begins, begins + window, len(chunk.at))
            kept, spans = [], []
            for number, text in enumerate(texts):
                words = text.split()
                lost = gone[chunk.first[number] : chunk.first[number + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], lost, [False]]).astype(np.int8)))
                for begin, end in zip(edges[-2::-2], edges[::-2], strict=True):
                    del words[begin:end]
                kept.append(b" ".join(words))
                spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(chunk.count, pa.int64()),
                    pa.array(np.bincount(chunk.text[gone], minlength=len(texts)), pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n_words", "n_removed", "spans", "kept"],
            )

    schema = schema_of(
        id_field(rows, "id"), "n_words long", "n_removed long", "spans array<struct<start: int, length: int>>", "kept string"
    )
    return rows.select("id", "text", "marks", "firsts").mapInArrow(task, schema)


def without_repeated_passages(docs: DataFrame, window: int = 20, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document without the words of windows that stand earlier.

    ``key``, n_words, n_removed, ``spans`` of removed words (start and length), and ``kept``: the words left, joined by
    one space. Windows are judged on the input, and earlier is: in a document before, or earlier in the same one.
    """
    rows = _numbered(docs, text, key)
    shared = staged(
        _anchors(rows, window, placed=False).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
        "shared",
    )
    marks = staged(
        _anchors(rows, window, placed=True)
        .join(shared, "hash", "left_semi")
        .groupBy("row")
        .agg(F.collect_set("at").alias("marks")),
        "marks",
    )
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row", "at")
    firsts = staged(
        _windows(rows.join(marks, "row"), window)
        .groupBy("one", "two")
        .agg(F.min(order).alias("first"))
        .groupBy("first.row")
        .agg(F.collect_list("first.at").alias("firsts")),
        "firsts",
    )
    left = _without(rows.join(marks.join(firsts, "row", "left"), "row", "left"), window)
    return left.withColumnRenamed("id", key) if key != "id" else left


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("*", F.sha2("kept", 256).alias("kept_sha256")).drop("kept", "spans")
