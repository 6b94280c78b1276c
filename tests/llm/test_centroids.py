"""Clusters of vectors against a plain version with Python integers."""

import hashlib
import math

import numpy as np
import pytest

from clearlot.llm import centroids, queries
from clearlot.llm.common import table


def plain(rows, dimensions=64, clusters=8, rounds=10, seed=3):
    kept = [
        (key, [math.floor(1024 * float(x)) for x in vector])
        for key, vector in rows
        if vector is not None and len(vector) == dimensions
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    hashed = sorted((hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest(), k or 0, v) for k, v in kept)
    middle = [list(v) for _, _, v in hashed[:clusters]]

    def choose(vector):
        found = [sum((a - b) ** 2 for a, b in zip(vector, one, strict=True)) for one in middle]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        members = [[] for _ in middle]
        for _, vector in kept:
            members[choose(vector)[0]].append(vector)
        for at, group in enumerate(members):
            if group:
                middle[at] = [sum(column) // len(group) for column in zip(*group, strict=True)]
    made = [(key, *choose(vector)) for key, vector in kept]
    total = sum(row[2] for row in made)
    each = [sum(row[2] for row in made if row[1] == at) for at in range(len(middle))]
    return sorted(
        ((key, at, far, each[at], total, centroids.centroid_digest(middle[at])) for key, at, far in made), key=repr
    )


def result(frame):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=repr)


def test_query_matches_plain_version(spark, folder):
    rows = [(row.vec_id, row.embedding) for row in table(spark, folder, "embeddings").collect()]
    assert result(queries.QUERIES["op12_centroids"](spark, folder)) == plain(rows)


SHAPE = "vec_id long, embedding array<float>, cluster int, id string, vector string"


@pytest.mark.parametrize("partitions", [1, 5])
def test_odd_vectors(spark, partitions):
    rng = np.random.default_rng(4)
    good = [(at, rng.normal(0, 3, 4).astype(np.float32).tolist()) for at in range(60)]
    good += [(7, good[3][1]), (3, good[3][1]), (3, good[3][1]), (None, [0.5, -0.5, 0.0, 1.0]), (91, [1e5, -1e5, 0.0, 7.0])]
    odd = [(70, None), (71, []), (72, [1.0] * 3), (73, [1.0] * 5), (74, [1.0, None, 2.0, 3.0]),
           (75, [1.0, float("nan"), 0.0, 0.0]), (76, [float("inf"), 0.0, 0.0, 0.0]), (77, [0.0, 0.0, 0.0, -float("inf")])]
    frame = spark.createDataFrame([(*row, 9, "x", "y") for row in good + odd], SHAPE).repartition(partitions)
    found = centroids.digests(centroids.cluster(frame, dimensions=4, clusters=5, rounds=4))
    assert result(found) == plain(good + odd, dimensions=4, clusters=5, rounds=4)


def test_ties_take_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(at, [1.0, 1.0]) for at in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = centroids.cluster(frame, dimensions=2, clusters=3, rounds=2).collect()
    assert len(found) == 6 and {(row.cluster, row.distance, row.inertia) for row in found} == {(0, 0, 0)}
    few = spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")
    assert centroids.cluster(few, dimensions=2, clusters=8).count() == 2


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        found = centroids.digests(centroids.cluster(frame))
        assert found.collect() == [] and "centroid_sha256" in found.columns


def test_too_large_components_are_refused(spark):
    frame = spark.createDataFrame([(1, [2e5, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="components must be smaller"):
        centroids.cluster(frame, dimensions=2).collect()


def test_tables_hold_what_occurs():
    rng = np.random.default_rng(2)
    for spread in (5, 40_000, 1 << 26):
        values = rng.integers(-spread, spread, 300)
        integers, places = centroids._occurring(values)
        assert (integers == np.unique(values)).all() and (integers[places] == values).all()
    middle = rng.integers(-9, 9, (3, 6))
    rows = rng.integers(-9, 9, (50, 6))
    chosen, far = centroids.nearest(rows, middle)
    all_far = ((rows[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (chosen == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
