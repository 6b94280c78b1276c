"""Removal of byte strings that a document with a smaller id also holds, by suffix arrays.

A window is a string of ``WINDOW`` bytes. Every window has an anchor, the run of ``GRAM`` bytes in it with the least hash,
so equal windows have equal anchors wherever they stand. A window holds half of its other bytes, or more, on the left of the
anchor or else on its right; the anchor and so many bytes on that side are the window's core, and equal windows have equal
cores. Consecutive windows with one core are a piece. Only pieces whose core occurs under two ids can hold a repeated
window. A bit map of the hashes of these cores, in the shared folder, tells the tasks which pieces to send; its size is
bounded, and where it is too small, or two cores share a bit, pieces are sent in vain but none is missed. First a piece is
sent as its place and a 64-bit hash of its bytes. Where all pieces of a core have one hash, that piece and its least id stand
for all. Where they differ, one of each kind goes, with its bytes and its least id, to a shard by the hash of the core.
There are as many shards as the counted bytes ask for. A core whose different pieces would fill a shard by themselves is
split: its pieces are cut into single windows, which go to shards by their own hashes.

A shard sorts the suffixes of its pieces: first by eight bytes, then, in Larsson and Sadakane's way, groups that are not
sorted yet by the rank of what follows, twice as far each time. The common prefixes of neighbours come from Kasai's rule,
along all pieces at once. Neighbours that share a whole window form a group, with the least id of its pieces. A shard that
came out larger than ``SHARD_BYTES`` makes several suffix arrays, merged by binary search for the windows of one in the others.
The bytes of every window whose group has a smaller id than its document are removed.

Texts are UTF-8; null texts are empty. Rows without an id lose nothing and take nothing. Rows with the same id do not count
as smaller than each other. Windows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, in_python, schema_of, text_or_empty
from clearlot.session import fresh_folder, staged

WINDOW = 50
GRAM = 16
#: Windows of a text that are looked at together.
CHUNK = 1 << 22
SHARD_BYTES = 1 << 22
#: Bytes of short texts that are looked at together, and pieces that a task hands back at once.
BYTES_TOGETHER = 1 << 18
PIECES_AT_ONCE = 50_000
#: Up to this many spans to remove are broadcast, with their documents; more are shuffled.
BROADCAST_SPANS = 500_000
#: The same for cores.
BROADCAST_KEYS = 500_000
#: Bits of the map for each anchor, and in all; bits of a slice, which one task makes.
BITS_PER_ANCHOR = 32
MOST_BITS = 1 << 31
SLICE_BITS = 1 << 22

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of the ``size`` bytes, a power of two, from each place on."""
    values = (data.astype(np.uint64) + np.uint64(1)) * _A
    values ^= values >> np.uint64(29)
    step = 1
    while step < size:
        values = values[:-step] * _B + values[step:] * _C + np.uint64(step)
        values ^= values >> np.uint64(31)
        step *= 2
    return values


def pieces_of(
    data: np.ndarray, window: int = WINDOW, gram: int = GRAM, sizes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Core hash, first and last window start of each piece of a text, or of texts of these sizes that follow each other."""
    made = []
    beside = (window - gram + 1) // 2  # bytes of a core beside the anchor
    borders = np.cumsum([len(data)] if sizes is None else sizes)
    for start in range(0, max(0, len(data) - window + 1), CHUNK):
        part = data[start : start + CHUNK + window - 1]
        hashes = gram_hashes(part, gram)
        low = np.uint64((1 << 24) - 1)
        least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))  # of equal hashes the last is least
        span, reach = window - gram + 1, 1
        while 2 * reach <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
        anchors = (low - (least & low)).astype(np.int64)
        # the last window of a text begins a window before its end; those from there on, up to the border, are none
        ends = borders[(borders > start) & (borders < start + len(part))] - start
        edges = np.zeros(len(anchors) + 1, bool)
        edges[0] = True
        edges[1:-1] = anchors[1:] != anchors[:-1]
        edges[np.minimum(ends, len(anchors))] = True
        crossing = np.zeros(len(anchors) + 1, np.int32)
        np.add.at(crossing, np.minimum(np.maximum(ends - window + 1, 0), len(anchors)), 1)
        np.add.at(crossing, np.minimum(ends, len(anchors)), -1)
        whole = np.cumsum(crossing[:-1]) == 0
        edges[1:-1] |= whole[1:] != whole[:-1]
        first = np.flatnonzero(edges[:-1])
        last = np.concatenate([first[1:], [len(anchors)]]) - 1
        first, last = first[whole[first]], last[whole[first]]
        places = anchors[first]
        left, right = first <= places - beside, last > places - beside
        made.append((_cores(hashes, places[left], -1, beside, gram), first[left], np.minimum(last, places - beside)[left]))
        made.append((_cores(hashes, places[right], 1, beside, gram), np.maximum(first, places - beside + 1)[right], last[right]))
        made[-2:] = [(core, one + start, other + start) for core, one, other in made[-2:]]
    if not made:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(columns) for columns in zip(*made, strict=True))


def _cores(hashes: np.ndarray, anchors: np.ndarray, side: int, beside: int, gram: int) -> np.ndarray:
    """Hashes of anchors with the bytes on their left (``side`` -1) or right (1)."""
    values = hashes[anchors] + np.uint64(side + 2)
    for shift in range(beside, 0, -gram):
        values = (values ^ (values >> np.uint64(29))) * _B + hashes[anchors + side * shift] * _C
    return (values ^ (values >> np.uint64(31))).view(np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of a text in the order of its suffixes."""
    count = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(count, np.uint64)
    for at in range(8):
        keys = (keys << np.uint64(8)) | padded[at : at + count]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    ranks = np.full(count + 1, -1, np.int64)  # the last one is that of the empty suffix
    ranks[order] = np.maximum.accumulate(np.where(new, np.arange(count), 0))
    known = 8
    while True:
        again = ~new
        again[:-1] |= ~new[1:]
        where = np.flatnonzero(again)
        if not len(where):
            return order
        places = order[where]
        both = ranks[places] * (count + 1) + ranks[np.minimum(places + known, count)] + 1
        sort = np.argsort(both, kind="stable")
        both, places = both[sort], places[sort]
        order[where] = places
        first = np.concatenate([[True], both[1:] != both[:-1]])
        new[where] = first
        ranks[places] = np.maximum.accumulate(np.where(first, where, 0))
        known *= 2


def common_prefixes(
    text: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, limit: int = WINDOW
) -> np.ndarray:
    """How many bytes, up to ``limit``, each suffix shares with the one before it in the order.

    Along a piece the number falls by one at most from one place to the next; all pieces go on together, place by place.
    """
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    before = np.where(rank > 0, order[rank - 1], len(text))
    padded = np.concatenate([text, np.zeros(2 * limit, np.uint8)])
    found = np.zeros(len(order), np.int64)
    longest = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[longest], sizes[longest]
    held = np.zeros(len(starts), np.int64)
    for at in range(int(sizes.max(initial=0))):
        going = int(np.searchsorted(-sizes, -at, side="left"))
        places = starts[:going] + at
        other = before[places]
        shared = np.maximum(held[:going] - 1, 0)
        open_ = np.flatnonzero((shared < limit) & (other < len(text)))
        while len(open_):
            same = padded[places[open_] + shared[open_]] == padded[other[open_] + shared[open_]]
            open_ = open_[same]
            shared[open_] += 1
            open_ = open_[shared[open_] < limit]
        shared[other == len(text)] = 0
        held = shared
        found[places] = shared
    return found[order]


def least_ids(pieces: list[bytes], ids: np.ndarray, window: int = WINDOW, most: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each piece the least id that holds each of its windows; pieces are spread over suffix arrays of bounded size."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    shard = np.cumsum(lengths + 1) // most
    arrays, result = [], [np.zeros(0, np.int64)] * len(pieces)
    for number in np.unique(shard):
        chosen = np.flatnonzero(shard == number)
        text = np.frombuffer(b"\xff".join([pieces[i] for i in chosen]) + b"\xff", np.uint8) + np.uint8(1)
        sizes = lengths[chosen] + 1  # with the separator, 0 in the text, which is less than any byte of UTF-8
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order = suffix_array(text)
        shared = common_prefixes(text, order, starts, sizes, window)
        windows = np.zeros(len(text), np.int64)
        windows[starts] += 1
        windows[starts + lengths[chosen] - window + 1] -= 1
        whole = np.cumsum(windows)[order] > 0  # suffixes that begin with a window
        owner = np.repeat(ids[chosen], sizes)
        group = np.cumsum(shared < window)[whole]
        places = order[whole]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        least = np.minimum.reduceat(owner[places], first)
        counts = np.diff(np.concatenate([first, [len(places)]]))
        arrays.append((chosen, starts, text, places, places[first], counts, least))
    strings = [_strings(text, heads, window) for _, _, text, _, heads, _, _ in arrays] if len(arrays) > 1 else []
    for one in range(len(strings)):
        for other in range(one + 1, len(strings)):
            _merge(strings[one], arrays[one][6], strings[other], arrays[other][6])
    for chosen, starts, text, places, _, counts, least in arrays:
        by_place = np.zeros(len(text), np.int64)
        by_place[places] = np.repeat(least, counts)
        for which, start in zip(chosen, starts, strict=True):
            result[which] = by_place[start : start + lengths[which] - window + 1]
    return result


def _strings(text: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """The windows at some places, in order; a last byte keeps zeros at the end from being dropped."""
    rows = np.ones((len(places), window + 1), np.uint8)
    rows[:, :window] = text[places[:, None] + np.arange(window)]
    return rows.view(f"S{window + 1}").ravel()


def _merge(ours: np.ndarray, our_least: np.ndarray, theirs: np.ndarray, their_least: np.ndarray) -> None:
    """Binary search for the windows of one suffix array in another; both get the lesser ids."""
    at = np.minimum(np.searchsorted(ours, theirs), len(ours) - 1)
    same = np.flatnonzero(ours[at] == theirs)
    both = np.minimum(our_least[at[same]], their_least[same])
    our_least[at[same]] = both
    their_least[same] = both


def _small(frame: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def _bit_map(anchors: DataFrame) -> tuple[str, int]:
    """The folder of a bit map of the anchors and its number of bits, a power of two."""
    spark, count = anchors.sparkSession, anchors.count()
    bits = min(MOST_BITS, max(SLICE_BITS, 1 << (BITS_PER_ANCHOR * count).bit_length()))
    schema = schema_of("slice long", "bits binary")

    def pack(table: pa.Table) -> pa.Table:
        flags = np.zeros(SLICE_BITS, np.uint8)
        numbers = table.column("bit").to_numpy()
        flags[numbers % SLICE_BITS] = 1
        columns = {"slice": pa.array([int(numbers[0]) // SLICE_BITS]), "bits": pa.array([np.packbits(flags).tobytes()])}
        return pa.table(columns, schema=pa.schema([("slice", pa.int64()), ("bits", pa.binary())]))

    place = fresh_folder(spark, "anchor-map")
    (
        anchors.select(F.col("anchor").bitwiseAND(F.lit(bits - 1)).alias("bit"))
        .withColumn("slice", F.floor(F.col("bit") / SLICE_BITS))
        .groupBy("slice")
        .applyInArrow(pack, schema)
        .write.parquet(place)
    )
    return place, bits


@lru_cache(maxsize=1)
def _read_bit_map(place: str, bits: int) -> np.ndarray:
    """The whole map, once for each Python worker."""
    system, path = fs.FileSystem.from_uri(place if "://" in place else f"file://{place.removeprefix('file:')}")
    whole = np.zeros(bits // 8, np.uint8)
    for found in system.get_file_info(fs.FileSelector(path)):
        if found.base_name.startswith("part-"):
            table = parquet.read_table(found.path, filesystem=system)
            for number, packed in zip(table.column("slice").to_pylist(), table.column("bits").to_pylist(), strict=True):
                start = number * (SLICE_BITS // 8)
                whole[start : start + SLICE_BITS // 8] = np.frombuffer(packed, np.uint8)
    return whole


def _marked(anchors: np.ndarray, bit_map: np.ndarray) -> np.ndarray:
    bit = anchors & np.int64(8 * len(bit_map) - 1)
    return (bit_map[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0


def piece_hashes(hashes: np.ndarray, first: np.ndarray, ends: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the bytes from each first place up to each end, from those of the grams that cover them."""
    values, last = (ends - first).astype(np.uint64), ends - gram
    for shift in range(0, int((last - first).max(initial=0)) + gram, gram):
        mixed = (values ^ (values >> np.uint64(31))) * _C + hashes[np.minimum(first + shift, last)] * _A
        values = np.where(first + shift < ends, mixed, values)  # no matter how long the other pieces are
    return ((values ^ (values >> np.uint64(29))) * _B).view(np.int64)


def _pieces(own: DataFrame, window: int, gram: int, bit_map: tuple[str, int] | None = None) -> DataFrame:
    """``anchor, id`` of all pieces; with a bit map, ``digest, hash, start, size`` of those that it marks, too."""
    with_places = bit_map is not None
    more = ["digest long", "hash long", "start int", "size int"] * with_places
    schema = schema_of("anchor long", "id long", *more)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        marks = _read_bit_map(*bit_map) if with_places else None
        for batch in batches:
            for keys, digests, texts in _together(batch):
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                data = np.frombuffer(b"".join(texts), np.uint8)
                anchors, first, last = pieces_of(data, window, gram, sizes)
                if with_places:
                    chosen = _marked(anchors, marks)
                    anchors, first, last = anchors[chosen], first[chosen], last[chosen]
                if not len(anchors):
                    continue
                borders = np.cumsum(sizes)
                owner = np.searchsorted(borders, first, side="right")
                columns = [anchors, keys[owner]]
                if with_places:
                    ends = last + window
                    starts = first - (borders - sizes)[owner]
                    columns += [digests[owner], _hashed(data, first, ends, gram), starts, ends - first]
                for at in range(0, len(anchors), PIECES_AT_ONCE):
                    part = zip((column[at : at + PIECES_AT_ONCE] for column in columns), arrow, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(v.astype(f.type.to_pandas_dtype()), f.type) for v, f in part], schema=arrow)

    return own.select("id", "text", "digest").mapInArrow(task, schema)


def _hashed(data: np.ndarray, first: np.ndarray, ends: np.ndarray, gram: int) -> np.ndarray:
    """``piece_hashes`` of a text, whose grams are hashed some at a time."""
    made, parts = np.zeros(len(first), np.int64), first // CHUNK
    for part in np.unique(parts):
        chosen, start = parts == part, int(part) * CHUNK
        hashes = gram_hashes(data[start : int(ends[chosen].max())], gram)
        made[chosen] = piece_hashes(hashes, first[chosen] - start, ends[chosen] - start, gram)
    return made


def _together(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, digests and coded texts of a batch, some texts at a time, a long one by itself."""
    keys, digests = batch.column(0).to_numpy(), batch.column(2).to_numpy()
    texts, held, first = [], 0, 0
    for at, text in enumerate(batch.column(1)):
        texts.append(text.as_buffer().to_pybytes())
        held += len(texts[-1])
        if held >= BYTES_TOGETHER or at + 1 == batch.num_rows:
            yield keys[first : at + 1], digests[first : at + 1], texts
            texts, held, first = [], 0, at + 1


def _with_bytes(kinds: DataFrame, own: DataFrame) -> DataFrame:
    """``anchor, hash, least, piece``: the bytes come from the text that holds the first piece of its kind."""
    wanted = F.struct("anchor", "hash", "start", "size")
    places = kinds.groupBy("id", "digest").agg(F.collect_list(wanted).alias("wanted"))
    texts = own.select("id", "digest", F.col("text").cast("binary").alias("data")).dropDuplicates(["id", "digest"])
    taken = F.transform(
        "wanted",
        lambda one: F.struct(
            one["anchor"].alias("anchor"), one["hash"].alias("hash"), F.substring(F.col("data"), one["start"] + 1, one["size"]).alias("piece")
        ),
    )
    rows = texts.join(places, ["id", "digest"]).select(F.col("id").alias("least"), F.explode(taken).alias("one"))
    return rows.select("one.anchor", "one.hash", "least", "one.piece")


def _windows(pieces: DataFrame, window: int) -> DataFrame:
    """Every window of the pieces: ``anchor, hash, first``, and ``core, piece, kind, least`` as it goes by its own hash."""
    places = F.explode(F.sequence(F.lit(0), F.length("piece") - window))
    cut = pieces.withColumn("first", places).withColumn("piece", F.substring("piece", F.col("first") + 1, F.lit(window)))
    return cut.withColumn("core", F.xxhash64("piece")).withColumn("kind", F.xxhash64(F.lit("window"), "piece"))


def repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``id, digest, spans`` (first byte, byte after the last) to remove; spans may overlap."""
    own = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text")
    )
    own = own.where(F.octet_length("text") >= window).withColumn("digest", F.xxhash64("text"))
    shared = staged(
        _pieces(own, window, gram)
        .groupBy("anchor")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("anchor"),
        "anchors",
    )
    found = staged(_pieces(own, window, gram, _bit_map(shared)), "pieces")
    cores = staged(
        found.groupBy("anchor")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        .where("least < most"),
        "cores",
    )
    # pieces that differ: one of each kind, with its bytes
    mixed = _small(cores.where("low < high").select("anchor"), BROADCAST_KEYS)
    place = F.min(F.struct("id", "digest", "start", "size")).alias("place")
    kinds = found.join(mixed, "anchor", "left_semi").groupBy("anchor", "hash").agg(place)
    pieces = staged(_with_bytes(staged(kinds.select("anchor", "hash", "place.*"), "kinds"), own), "bytes")
    bytes_held = F.sum(F.length("piece") + 1)
    hot = staged(pieces.groupBy("anchor").agg(bytes_held.alias("held")).where(F.col("held") > shard_bytes), "hot")
    windows = None
    if not hot.isEmpty():
        hot = _small(hot.select("anchor"), BROADCAST_KEYS)
        windows = staged(_windows(pieces.join(hot, "anchor", "left_semi"), window), "windows")
        own_windows = windows.groupBy("core", "piece").agg(F.min("least").alias("least"), F.first("kind").alias("hash"))
        pieces = staged(
            pieces.join(hot, "anchor", "left_anti").unionByName(own_windows.withColumnRenamed("core", "anchor")), "bytes"
        )
    held = pieces.agg(bytes_held.alias("held")).first()["held"] or 0
    shards = 1 + max(2 * held // shard_bytes, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    told = schema_of("anchor long", "hash long", "first int", "last int", "least long")

    def shard(table: pa.Table) -> pa.Table:
        """Runs of windows of each piece with the least id that holds them."""
        from pyspark.sql.pandas.types import to_arrow_schema

        owners, firsts, lasts, leasts = [], [], [], []
        found_ids = least_ids(table.column("piece").to_pylist(), table.column("least").to_numpy(), window, shard_bytes)
        for number, least in enumerate(found_ids):
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            owners.append(np.full(len(first), number))
            firsts.append(first)
            lasts.append(np.concatenate([first[1:], [len(least)]]) - 1)
            leasts.append(least[first])
        owner = np.concatenate(owners)
        columns = [table.column(name).to_numpy()[owner] for name in ("anchor", "hash")]
        columns += [np.concatenate(firsts), np.concatenate(lasts), np.concatenate(leasts)]
        arrow = to_arrow_schema(told)
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    answers = (
        pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(shard, told)
    )
    if windows is not None:
        answers = staged(answers, "answers")
        each = answers.select(F.col("anchor").alias("core"), F.col("hash").alias("kind"), F.col("least").alias("told"))
        split = windows.join(each, ["core", "kind"]).select(
            "anchor", "hash", "first", F.col("first").alias("last"), F.col("told").alias("least")
        )
        answers = answers.unionByName(split)
    alike = cores.where("low = high").select("anchor", F.col("low").alias("hash"), F.lit(0).alias("first"), F.lit(-1).alias("last"), "least")
    answers = answers.unionByName(alike)
    last = F.when(F.col("last") < 0, F.col("size") - window).otherwise(F.col("last"))
    span = F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + last + window).alias("end"))
    return (
        found.select("anchor", "hash", "id", "digest", "start", "size")
        .join(answers, ["anchor", "hash"])
        .where(F.col("least") < F.col("id"))
        .groupBy("id", "digest")
        .agg(F.collect_list(span).alias("spans"))
    )


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per document ``n_bytes, n_removed, n_spans`` and ``kept``, the bytes that are left; other columns are left out."""
    gone = staged(repeated_spans(docs, id_column, text_column, window, gram), "spans")
    held = gone.agg(F.sum(F.size("spans"))).first()[0] or 0
    gone = gone.withColumnsRenamed({"id": "its_id", "digest": "its_digest"})
    gone = F.broadcast(gone) if held <= BROADCAST_SPANS else gone.hint("merge")
    own = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    same = (F.col("id") == F.col("its_id")) & (F.xxhash64("text") == F.col("its_digest"))
    joined = own.join(gone, same, "left").select(
        F.col("id").alias(id_column), "text", F.col("spans.first").alias("first"), F.col("spans.end").alias("end")
    )
    schema = schema_of(
        id_field(docs, id_column), "n_bytes long", "n_removed long", "n_spans long", "kept binary"
    )

    def start():
        def row(key, text, first, end) -> tuple:
            data = text.encode("utf-8", "surrogatepass")
            if not first:
                return key, len(data), 0, 0, data
            edges = np.zeros(len(data) + 1, np.int64)
            np.add.at(edges, first, 1)
            np.add.at(edges, end, -1)
            gone = np.cumsum(edges[:-1]) > 0
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            left = np.frombuffer(data, np.uint8)[~gone].tobytes()
            return key, len(data), int(gone.sum()), runs, left

        return row

    return in_python(joined, schema, start, measure=1)


def digest(kept: DataFrame) -> DataFrame:
    """The same with ``kept_sha256`` in place of the bytes."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
