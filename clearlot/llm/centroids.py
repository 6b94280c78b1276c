"""Clusters of integer vectors around centroids, with distances looked up in small tables of squared differences.

Components are turned into integers, so that every sum is exact and results do not depend on partitions. In each round a
task tabulates, for every batch of vectors and every dimension, the squared difference between each integer that occurs
there and each centroid; the distance of a vector is the sum of one table row for each dimension. Only counts and sums
of the members of each centroid leave a task, and only the centroids themselves pass through the driver.

* Kept are vectors with exactly ``dimensions`` components, none null or not finite; other rows, null vectors and empty
  ones among them, are not in the result. An empty table, or one without such a vector, gives an empty result.
* Repeated rows are vectors of their own. Rows without an id are clustered too; as first centroids they count with an empty
  id. Vectors with one hash are ordered by id, then by components.
* With fewer vectors than centroids there are as many centroids as vectors.
* Other columns do not matter, whatever their names.
* Components of 131 072 or more in size raise an error, as distances might no longer fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot.llm.common import id_field, schema_of
from clearlot.session import staged

SCALE, LIMIT = 1024, 1 << 27
#: Integers that lie closer together than this are counted to find those that occur, others are sorted.
DENSE = 1 << 16


def integer_vectors(frame: DataFrame, vector: str, key: str, dimensions: int) -> DataFrame:
    """``id, vector``: the kept vectors as little-endian 32-bit integers ``floor(SCALE * x)``."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = frame.where((F.size(vector) == dimensions) & finite)
    kept = kept.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            scaled = np.floor(SCALE * values)
            if np.any(np.abs(scaled) >= LIMIT):
                raise ValueError(f"components must be smaller than {LIMIT // SCALE}")
            whole = scaled.astype("<i4").reshape(batch.num_rows, dimensions)
            packed = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["id", "vector"])

    return kept.mapInArrow(task, schema_of(id_field(kept, "id"), "vector binary"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The vectors of a batch as rows of integers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dimensions)


def _occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers among ``values``, and the place of each value in them."""
    low, high = int(values.min()), int(values.max())
    if high - low >= DENSE:
        return np.unique(values, return_inverse=True)
    shifted = values - low
    there = np.bincount(shifted, minlength=high - low + 1) > 0
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[shifted]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid for each vector, the smaller among equals, and the squared distance."""
    distances = np.zeros((len(vectors), len(centroids)), np.int64)
    for dimension in range(vectors.shape[1]):
        integers, places = _occurring(vectors[:, dimension])
        table = (integers.astype(np.int64)[:, None] - centroids[None, :, dimension]) ** 2
        distances += table[places]
    chosen = distances.argmin(axis=1)
    return chosen, distances[np.arange(len(vectors)), chosen]


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number of members and componentwise sums for each centroid that has members."""
    dimensions = centroids.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0), dimensions)
                chosen, _ = nearest(rows, centroids)
                for cluster in np.unique(chosen):
                    members = rows[chosen == cluster]
                    counts[cluster] += len(members)
                    sums[cluster] += members.sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(used, pa.int32()),
            "members": pa.array(counts[used], pa.int64()),
            "sums": pa.array(sums[used].tolist(), pa.list_(pa.int64())),
        })

    parts = vectors.select("vector").mapInArrow(task, schema_of("cluster int", "members long", "sums array<long>"))
    total = parts.groupBy("cluster").agg(
        F.sum("members").alias("members"),
        F.array(*[F.sum(F.col("sums")[at].cast("decimal(38,0)")) for at in range(dimensions)]).alias("sums"),
    )
    return {row.cluster: (int(row.members), [int(one) for one in row.sums]) for row in total.collect()}


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray | None:
    """The vectors whose ids have the least hashes, in the order of the hashes."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(text, 256), "id", "vector").limit(count).select("vector").collect()
    return np.array([np.frombuffer(row.vector, "<i4") for row in rows], np.int64) if rows else None


def cluster(
    frame: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    dimensions: int = 64,
    clusters: int = 8,
    rounds: int = 10,
    seed: int = 3,
    on_round: Callable[[int, np.ndarray], None] | None = None,
) -> DataFrame:
    """The cluster of every kept vector: ``key``, cluster, distance, cluster_inertia, inertia, centroid.

    ``centroid`` is the final centroid's components. ``on_round`` sees the centroids after each round.
    """
    spark = frame.sparkSession
    vectors = staged(integer_vectors(frame, vector, key, dimensions), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    out = schema_of(id_field(vectors, "id"), "cluster int", "distance long")
    if centroids is None:
        empty = schema_of(id_field(vectors, "id").replace("id ", f"`{key}` ", 1), "cluster int", "distance long",
                          "cluster_inertia long", "inertia long", "centroid array<long>")
        return spark.createDataFrame([], empty)
    for number in range(rounds):
        for at, (members, sums) in _sums(vectors, centroids).items():
            centroids[at] = [one // members for one in sums]
        if on_round is not None:
            on_round(number, centroids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chosen, distance = nearest(_matrix(batch.column(1), dimensions), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(chosen, pa.int32()), pa.array(distance, pa.int64())],
                    names=["id", "cluster", "distance"],
                )

    assigned = staged(vectors.mapInArrow(task, out), "assigned")
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    inertia = sum(int(row.inertia) for row in totals)
    summary = spark.createDataFrame(
        [(row.cluster, int(row.inertia), inertia, centroids[row.cluster].tolist()) for row in totals],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    # at most one row for each centroid
    return assigned.join(F.broadcast(summary), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(components: list[int]) -> str:
    """What ``digests`` gives for one centroid."""
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()


def digests(clustered: DataFrame) -> DataFrame:
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return clustered.select("*", F.sha2(text, 256).alias("centroid_sha256")).drop("centroid")
