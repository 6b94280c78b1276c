"""Sketches that merge, tests of distributions, late rows and the streamed newest row, against plain versions."""

import bisect
import math
import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from clearlot.operators import distributions, merge, sketches
from clearlot.session import fresh_folder
from clearlot.streaming.incremental import watch_folder
from clearlot.streaming.latest import latest_rows, load_latest

WANTED = sketches.Wanted(distinct=("code",), numbers=("n",), values=("kind",))


def _figures(profiles, by=()):
    found = profiles.select(
        *by, "rows", sketches.distinct_estimate("code"), sketches.surplus_estimate("code"), sketches.quantile_estimates("n", (0.0, 0.5, 1.0))
    )
    return sorted((tuple(row) for row in found.collect()), key=repr)


def test_profiles_of_odd_rows(spark):
    rows = [("t", None, None, None), ("t", "a", float("nan"), "x"), ("t", "a", float("inf"), "x"), ("t", "b", 3.0, None),
            ("t", "", -1.0, "y"), ("u", None, None, None), (None, "z", 5.0, "x")]
    frame = spark.createDataFrame(rows, "tenant string, code string, n double, kind string")
    made = sketches.sketch_profile(frame, ["tenant"], WANTED)
    wanted = [(None, 1, 1, 0, [5.0, 5.0, 5.0]), ("t", 5, 3, 1, [-1.0, -1.0, 3.0]), ("u", 1, 0, 0, None)]
    assert _figures(made, ["tenant"]) == sorted(wanted, key=repr)
    merged = sketches.merge_profiles(made, WANTED)
    assert [row[:3] for row in _figures(merged)] == [(7, 4, 1)]
    assert rows_of(sketches.frequent_values(merged, "kind", 2), "kind", "rows") == [("x", 3), ("y", 1)] or (
        (None, 3) in rows_of(sketches.frequent_values(merged, "kind", 3), "kind", "rows")
    )
    assert sketches.sketch_profile(frame.where("false"), ["tenant"], WANTED).collect() == []


@pytest.mark.parametrize("groups", [1, 7, 30])
def test_merged_profiles_equal_one_pass(spark, groups):
    frame = spark.range(60_000, numPartitions=5).select(
        F.pmod("id", F.lit(groups)).alias("day"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("code"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)).cast("double").alias("n"),
        F.concat(F.lit("k"), F.floor(F.sqrt(F.pmod("id", F.lit(900)))).cast("string")).alias("kind"),
    )
    path = fresh_folder(spark, "profiles")
    sketches.store_profiles(sketches.sketch_profile(frame, ["day"], WANTED), path, ("day",))
    merged = sketches.merge_profiles(spark.read.parquet(path), WANTED)
    once = sketches.sketch_profile(frame, [], WANTED)
    exact = frame.agg(F.count_distinct("code")).first()[0]
    (rows, codes, surplus, quantiles), (_, codes_once, _, _) = _figures(merged)[0], _figures(once)[0]
    assert rows == 60_000 and codes == codes_once and surplus == rows - codes
    assert abs(codes - exact) <= exact * sketches.DISTINCT_ERROR
    assert abs(frame.where(F.col("n") <= quantiles[1]).count() / rows - 0.5) <= sketches.RANK_ERROR
    counts = {row["kind"]: row["count"] for row in frame.groupBy("kind").count().collect()}
    assert dict(rows_of(sketches.frequent_values(merged, "kind", 100), "kind", "rows")) == counts
    assert "Python" not in plan_of(merged)


@pytest.mark.parametrize(
    "statistic, degrees, chance",
    [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (11.070497693516351, 5, 0.05),
     (0.0, 3, 1.0), (0.001, 4, 0.9999998750416615), (30.0, 10, 0.0008566412), (900.0, 900, 0.4937312), (1e6, 3, 0.0)],
)
def test_chi_square_tail(spark, statistic, degrees, chance):
    found = spark.range(1).select(distributions.chi_square_tail(F.lit(statistic), degrees)).first()[0]
    assert abs(found - chance) < 1e-6


def test_chi_square_of_counts(spark):
    rows = [("a",)] * 45 + [("b",)] * 35 + [("c",)] * 20
    frame = spark.createDataFrame(rows, "v string")
    found = distributions.chi_square(frame, "v", {"a": 4, "b": 4, "c": 2, "never": 0}).first()
    assert (found["rows"], found["unexpected"], found["degrees"]) == (100, 0, 2)
    assert found["statistic"] == pytest.approx(25 / 40 + 25 / 40) and found["p_value"] == pytest.approx(math.exp(-0.625))
    odd = distributions.chi_square(frame.unionByName(spark.createDataFrame([("d",), (None,)], "v string")), "v", {"a": 4, "b": 4, "c": 2})
    assert odd.first()["unexpected"] == 2 and odd.first()["p_value"] == 0.0
    none = distributions.chi_square(frame.where("false"), "v", {"a": 1, "b": 1}).first()
    assert (none["rows"], none["statistic"], none["p_value"]) == (0, 0.0, 1.0)
    assert distributions.chi_square(frame.where("v = 'a'"), "v", {"a": 1}).first()["p_value"] == 1.0


def plain_distance(one, two):
    one, two = sorted(one), sorted(two)
    return max(abs(bisect.bisect_right(one, x) / len(one) - bisect.bisect_right(two, x) / len(two)) for x in one + two)


@pytest.mark.parametrize("seed", range(3))
def test_two_samples(spark, seed):
    draw = random.Random(seed)
    one = [round(draw.gauss(0, 3), 1) for _ in range(400)] + [7.0] * 200
    two = [round(draw.gauss(seed / 2, 3), 1) for _ in range(300)]
    rows = [(x, True) for x in one] + [(x, False) for x in two] + [(None, True), (1.0, None)]
    frame = spark.createDataFrame(rows, "n double, f boolean").repartition(6)
    found = distributions.two_samples(frame, "n", F.col("f")).first()
    assert (found["first_rows"], found["second_rows"]) == (600, 300)
    assert found["distance"] == pytest.approx(plain_distance(one, two))
    same = distributions.two_samples(frame.where("f").unionByName(frame.where("f").withColumn("f", F.lit(False))), "n", F.col("f")).first()
    assert same["distance"] == 0.0 and same["p_value"] == 1.0
    alone = distributions.two_samples(frame.where("f"), "n", F.col("f")).first()
    assert (alone["second_rows"], alone["distance"], alone["p_value"]) == (0, 0.0, 1.0)


def test_kolmogorov_tail(spark):
    many = F.lit(1e9)
    for reach, chance in ((1.3580986, 0.05), (1.6276236, 0.01), (0.1, 1.0), (9.0, 0.0)):
        distance = F.lit(reach / math.sqrt(5e8))
        assert abs(spark.range(1).select(distributions.kolmogorov_tail(distance, many, many)).first()[0] - chance) < 1e-4


def test_late_rows_of_the_newest_moment(spark):
    source = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (2, None), (3, "a"), (None, "c")], "t int, k string")
    target = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "t int, k string")
    found = merge.incremental_rows(source, target, "t", keys=["k"])
    assert found.columns == ["t", "k"]
    assert rows_of(found) == sorted([(2, "a"), (2, None), (3, "a"), (None, "c")], key=repr)
    again = merge.incremental_rows(source, target.unionByName(found), "t", keys=["k"])
    assert rows_of(again) == sorted([(None, "c")], key=repr)
    assert merge.incremental_rows(source, target.where("false"), "t", keys=["k"]).count() == source.count()


def _arrivals(spark, count, files, seed):
    """Rows of a few keys whose times jump about; written as files one after the other."""
    draw = random.Random(seed)
    rows = [(draw.randrange(12), f"2024-01-{draw.randrange(1, 29):02d} {draw.randrange(24):02d}:00:00" if draw.random() > 0.1 else None, draw.randrange(5)) for _ in range(count)]
    place = fresh_folder(spark, "arrivals")
    frame = spark.createDataFrame(rows, "k int, t string, v int").withColumn("t", F.to_timestamp("t"))
    for at in range(files):
        frame.where(F.pmod(F.xxhash64("k", "t", "v"), F.lit(files)) == at).coalesce(1).write.mode("append").parquet(place)
    return frame, place


@pytest.mark.parametrize("files_per_batch", [1, 4])
def test_streamed_latest_equals_dedupe_latest(spark, files_per_batch):
    frame, place = _arrivals(spark, 150, 4, 1)
    target, progress = fresh_folder(spark, "latest"), fresh_folder(spark, "progress")
    late = [load_latest(watch_folder(spark, place, frame.schema, files_per_batch=files_per_batch), target, progress, ["k"], "t", ["v"], "60 days")
            for _ in range(2)]
    assert late == [0, 0]
    found = latest_rows(spark, target, frame.schema, ["k"], "t", ["v"])
    assert rows_of(found) == rows_of(merge.dedupe_latest(frame, ["k"], "t", ["v"])) and found.count() == 12


def test_rows_that_come_too_late_are_counted(spark):
    place, target, progress = (fresh_folder(spark, one) for one in ("arrivals", "latest", "progress"))
    schema = "k int, t timestamp, v int"
    for rows in ([(1, "2024-03-01", 1)], [(2, "2024-01-01", 2), (3, "2024-02-29", 3), (4, None, 4)]):
        frame = spark.createDataFrame([(k, t, v) for k, t, v in rows], "k int, t string, v int").withColumn("t", F.to_timestamp("t"))
        frame.coalesce(1).write.mode("append").parquet(place)
        late = load_latest(watch_folder(spark, place, frame.schema, files_per_batch=1), target, progress, ["k"], "t", ["v"], "5 days")
    assert late == 1
    found = latest_rows(spark, target, spark.createDataFrame([], schema).schema, ["k"], "t", ["v"])
    assert [row[0] for row in rows_of(found, "k")] == [1, 3, 4]


def test_a_batch_of_the_stream_writes_one_row_of_a_key(spark):
    """However many spans of time a key has rows in: what is written, and held, follows the keys of a batch."""
    frame, place = _arrivals(spark, 150, 4, 2)
    target, progress = fresh_folder(spark, "latest"), fresh_folder(spark, "progress")
    load_latest(watch_folder(spark, place, frame.schema, files_per_batch=4), target, progress, ["k"], "t", ["v"], "60 days")
    written = spark.read.schema(frame.schema).option("recursiveFileLookup", "true").parquet(target)
    assert written.count() == 12
    assert rows_of(written) == rows_of(merge.dedupe_latest(frame, ["k"], "t", ["v"]))


def test_spans_are_forgotten_as_a_whole(spark):
    """A row is too late when its span has ended ``delay`` before the newest moment of the batches before."""
    place, target, progress = (fresh_folder(spark, one) for one in ("arrivals", "latest", "progress"))
    batches = [[(1, "2024-03-11 12:00:00")], [(2, "2024-02-29 23:59:59"), (3, "2024-03-01 00:00:00"), (4, "1960-01-01 00:00:00")]]
    for rows in batches:
        frame = spark.createDataFrame(rows, "k int, t string").withColumn("t", F.to_timestamp("t"))
        frame.coalesce(1).write.mode("append").parquet(place)
        late = load_latest(watch_folder(spark, place, frame.schema, files_per_batch=1), target, progress, ["k"], "t", delay="10 days")
    assert late == 2
    assert [row[0] for row in rows_of(latest_rows(spark, target, frame.schema, ["k"], "t"), "k")] == [1, 3]
