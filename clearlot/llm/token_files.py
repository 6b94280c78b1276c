"""Token ids as Arrow files of equal-length sequences.

Documents are dealt out by id ranges, each range to one task. The task writes one Arrow file whose batches hold two
fixed-size lists for every sequence, ``ids`` (unsigned 16-bit integers where the vocabulary allows, else 32-bit) and
``mask`` (true where there is an id). The ids of the documents follow each other, each document ending with ``end_id``;
only the last sequence of a file may be filled up. Files are mapped into memory to read them: sequence or document k is
found by arithmetic and is a view, not a copy, unless it crosses the border of a batch.

The index, one row for each document, names the file and the first id. A task writes under a name of its own and the
index carries that name, so files of lost or repeated tasks are never read. Null texts are empty texts, with nothing but
the end id. Documents with equal ids are ordered by text; null ids come first.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, schema_of, text_or_empty

SEQUENCE_LENGTH = 2048
#: Sequences of a batch; a task holds one batch.
BATCH_SEQUENCES = 256
#: Words, and parts of words, that a task remembers; a full table is emptied. Longer ones are not remembered.
TABLE_SIZE = 1_200_000
LONG = 48
#: Parts that the library gets as one text.
PARTS_TOGETHER = 2_000
#: Characters of text whose new words are encoded together.
CHARS_AT_ONCE = 400_000
#: Marks that are cut off the end of a word.
MARKS = ".,!?;|"


class _Table(dict):
    """Ids of words; a word that is not there is noted in ``new`` and gives None."""

    def __init__(self) -> None:
        super().__init__()
        self.new: dict[str, None] = {}

    def __missing__(self, word: str) -> None:
        self.new[word] = None


class WordTokenizer:
    """A tokenizer of the tokenizers library whose pieces never hold white space, and that knows no upper case.

    Only its added tokens are matched as they are written: words that look like one of them keep their upper case.
    Words between spaces and line breaks are then encoded apart, and so are a word and the marks at its end if there is
    a letter or digit before them. The library gets each such part once; its ids are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder()
        names = dict.fromkeys(one.content.lower() for one in added.values())
        raw = {
            one.content: number
            for number, one in added.items()
            if not (one.normalized or one.single_word or one.lstrip or one.rstrip)
        }
        self._mark, self._mark_id = next(iter(raw.items()), ("", -1))
        self._added = re.compile("|".join(map(re.escape, names)) or r"(?!)").search
        self._code = "H" if self.kind.itemsize == array("H").itemsize else "I"
        self._words = _Table()
        self._parts: dict[str, bytes] = {"": b""}

    def _cut(self, words: list[str]) -> list[tuple[str, str]]:
        """Each word without the marks at its end, and the marks, where both can be encoded apart."""
        looks = self._added if self._added("\n".join(words).lower()) else None
        cuts = []
        for word in words:
            plain = word
            if word.isascii():
                lower = word.lower()
                if looks is None or not looks(lower):
                    plain = lower
            if plain[-1:] in MARKS:
                head = plain.rstrip(MARKS)
                last = head[-1:]  # a letter that lower-casing and normalisation leave as it is
                if last.isalnum() and last < "\u0180" and last == last.lower():
                    cuts.append((head, plain[len(head) :]))
                    continue
            cuts.append((plain, ""))
        return cuts

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        cuts = self._cut(words)
        if len(self._parts) > TABLE_SIZE:
            self._parts = {"": b""}
        parts = self._parts
        new = list(dict.fromkeys(part for cut in cuts for part in cut if part not in parts))
        for start in range(0, len(new), PARTS_TOGETHER):
            some = new[start : start + PARTS_TOGETHER]
            parts.update(zip(some, self._encoded(some), strict=True))
        made = {word: parts[a] + parts[b] if b else parts[a] for word, (a, b) in zip(words, cuts, strict=True)}
        for part in new:
            if len(part) > LONG:
                del parts[part]
        return made

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """The packed ids of each part.

        An added token that is matched as it is written separates what stands around it, so the library can take all parts as
        one text with that token between them. Where a part holds something like an added token, or the token is not
        found as often as it was put, the parts are encoded one by one.
        """
        if self._mark and not self._added("\n".join(parts).lower()):
            whole = self.tokenizer.encode_batch_fast([self._mark.join(parts)], add_special_tokens=False)[0].ids
            ids = np.array(whole, self.kind)
            marks = np.flatnonzero(ids == self._mark_id)
            if len(marks) == len(parts) - 1:
                packed, size = ids.tobytes(), self.kind.itemsize
                starts, ends = [0, *((marks + 1) * size).tolist()], [*(marks * size).tolist(), len(packed)]
                return [packed[start:end] for start, end in zip(starts, ends, strict=True)]
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [self._packed(one.ids) for one in found]

    def _packed(self, ids: list[int]) -> bytes:
        made = array(self._code, ids)
        if sys.byteorder == "big":
            made.byteswap()
        return made.tobytes()

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The same for several texts, whose new words go to the library together."""
        known, made = self._words, []
        waiting: list[tuple[int, list[str], list[bytes | None]]] = []
        for at, text in enumerate(texts):
            words = text.replace("\n", " ").split(" ")
            found = list(map(known.__getitem__, words))
            if None in found:
                waiting.append((at, words, found))
                made.append(b"")
            else:
                made.append(b"".join(found))
        if not waiting:
            return made
        new = known.new
        known.new = {}
        if len(known) + len(new) > TABLE_SIZE:
            known.clear()
        learned = self._learned(list(new))
        known.update(learned)
        for at, words, found in waiting:
            place = -1
            for _ in range(found.count(None)):  # only these are looked up again
                place = found.index(None, place + 1)
                found[place] = learned[words[place]]
            made[at] = b"".join(found)
        for word in learned:
            if len(word) > LONG:
                del known[word]
        return made


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class SequenceWriter:
    """One Arrow file of equal-length sequences."""

    def __init__(self, uri: str, kind: np.dtype, length: int, batch: int):
        self.length, self.kind, self.size = length, kind, length * batch
        system, path = fs.FileSystem.from_uri(uri)
        system.create_dir(os.path.dirname(path), recursive=True)
        ids = pa.list_(pa.from_numpy_dtype(kind), length)
        self.schema = pa.schema([pa.field("ids", ids, False), pa.field("mask", pa.list_(pa.bool_(), length), False)])
        self.stream = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.stream, self.schema)
        self.parts: list[bytes] = []
        self.held = 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.held += len(ids) // self.kind.itemsize
        if self.held >= self.size:
            values = np.frombuffer(b"".join(self.parts), self.kind)
            whole = len(values) // self.size * self.size
            for start in range(0, whole, self.size):
                self._batch(values[start : start + self.size], self.size)
            self.parts, self.held = [values[whole:].tobytes()], len(values) - whole

    def _batch(self, values: np.ndarray, count: int) -> None:
        mask = pa.array(np.arange(len(values)) < count)
        made = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in (pa.array(values), mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(made, schema=self.schema))

    def close(self) -> None:
        if self.held:
            values = np.frombuffer(b"".join(self.parts), self.kind)
            filled = np.zeros(-(-len(values) // self.length) * self.length, self.kind)
            filled[: len(values)] = values
            self._batch(filled, len(values))
        self.writer.close()
        self.stream.close()


class SequenceFile:
    """Random access to a file of sequences, mapped into memory where the file system allows."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.per_batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def _values(self, batch: int) -> np.ndarray:
        return self.reader.get_batch(batch).column(0).flatten().to_numpy()

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the mask of one sequence."""
        batch, row = divmod(number, self.per_batch)
        ids, mask = self.reader.get_batch(batch).slice(row, 1).columns
        return ids.flatten().to_numpy(), mask.flatten().to_numpy(zero_copy_only=False)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on."""
        size, parts = self.length * self.per_batch, []
        while count:
            batch, at = divmod(start, size)
            part = self._values(batch)[at : at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def close(self) -> None:
        self.source.close()


def _slices(rows: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of a batch, some texts at a time, fewer if they are long."""
    keys, texts, chars = [], [], 0
    for key, text in zip(*(column.to_pylist() for column in rows.columns), strict=True):
        keys.append(key)
        texts.append(text)
        chars += len(text)
        if chars >= CHARS_AT_ONCE:
            yield keys, texts
            keys, texts, chars = [], [], 0
    if keys:
        yield keys, texts


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    length: int = SEQUENCE_LENGTH,
    batch: int = BATCH_SEQUENCES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Writes the ids of all documents below ``folder``, in ascending order of their ids, and returns the index.

    The index is a table in the same folder: the document's id, ``part`` (files in order), ``file``, ``first`` (the
    place of its first id in the file) and ``n_tokens``.
    """
    place = folder if "://" in folder else folder.replace("file:", "", 1) if folder.startswith("file:") else folder
    uri = place if "://" in place else f"file://{place}"
    schema = schema_of(id_field(docs, id_column), "part int", "file string", "first long", "n_tokens long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        own, end = word_tokenizer(tokenizer_path), None
        writer, first = None, 0
        for rows in batches:
            made = []
            for keys, texts in _slices(rows):
                if writer is None:
                    writer = SequenceWriter(f"{uri}/sequences/{name}", own.kind, length, batch)
                    end = np.array([end_id], own.kind).tobytes()
                for key, encoded in zip(keys, own.encode_all(texts), strict=True):
                    ids = encoded + end
                    writer.add(ids)
                    count = len(ids) // own.kind.itemsize
                    made.append((key, part, name, first, count))
                    first += count
            if made:
                arrow = to_arrow_schema(schema)
                columns = [pa.array(list(v), f.type) for v, f in zip(zip(*made, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if writer is not None:
            writer.close()

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col(id_column), text_or_empty(text_column).alias("text"))
        .repartitionByRange(parts, id_column)
        .sortWithinPartitions(id_column, "text")
        .mapInArrow(task, schema)
        .write.parquet(f"{folder}/index")
    )
    return spark.read.schema(schema).parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``, the number of ids before the document in all files."""
    index = spark.read.parquet(f"{folder}/index")
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("held"))  # a row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    return index.join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.col("first"))


def document_checksums(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Reads every document's ids back from the files: its start, its number of ids and their checksum.

    The checksum is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    index = read_index(spark, folder).select(id_column, "start", "n_tokens", "part", "file", "first")
    schema = schema_of(id_field(index, id_column), "start long", "n_tokens long", "ids_crc32 long")
    place = folder.replace("file:", "", 1) if folder.startswith("file:/") and "://" not in folder else folder
    uri = place if "://" in place else f"file://{place}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for rows in batches:
            keys, starts, counts, _, files, firsts = rows.columns
            sums = []
            for file, first, count in zip(files.to_pylist(), firsts.to_pylist(), counts.to_pylist(), strict=True):
                if file != name:
                    if opened is not None:
                        opened.close()
                    opened, name = SequenceFile(f"{uri}/sequences/{file}"), file
                sums.append(zlib.crc32(opened.ids(first, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [keys, starts, counts, pa.array(sums, pa.int64())],
                names=[id_column, "start", "n_tokens", "ids_crc32"],
            )

    return index.mapInArrow(task, schema)
