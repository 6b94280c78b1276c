"""Membership and reference checks against brute force, on both join strategies and with frequent keys."""

import random
import re

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from clearlot.operators import merge, references, rules
from clearlot.operators.members import Limits, flag_members, measure, members_only, orphans

SMALL = Limits()
SHUFFLED = Limits(broadcast_rows=0, broadcast_bytes=0, frequent_rows=20, frequent_keys=3)
#: Too many members to broadcast, but few keys that are none, or few that are.
ANSWERED = Limits(broadcast_rows=5, frequent_rows=20, frequent_keys=3)
BOTH = pytest.mark.parametrize("limits", [SMALL, SHUFFLED, ANSWERED], ids=["broadcast", "shuffle", "answers"])


def skewed_keys(count=600):
    """A third of the rows share one known key, a third one unknown key."""
    draw = random.Random(5)
    tail = [None, "", *[f"k{at}" for at in range(40)]]
    return [("hot" if at % 3 == 0 else "cold" if at % 3 == 1 else draw.choice(tail), at) for at in range(count)]


@BOTH
def test_flag_members(spark, limits):
    rows = skewed_keys()
    known = ["hot", "k1", "k2", "k2", "k39", None, "absent"]
    frame = spark.createDataFrame(rows, "key string, n int").repartition(7)
    ids = spark.createDataFrame([(value,) for value in known], "id string")
    found = flag_members(frame, "key", ids, "known", limits)
    assert found.columns == ["key", "n", "known"]
    expected = sorted([(key, n, key is not None and key in known) for key, n in rows], key=repr)
    assert rows_of(found) == expected
    assert rows_of(members_only(frame, "key", ids, limits)) == [(key, n) for key, n, hit in expected if hit]
    assert rows_of(orphans(frame, "key", ids, limits)) == [(key, n) for key, n, hit in expected if not hit]


def test_strategies(spark):
    frame = spark.createDataFrame(skewed_keys(), "key string, n int")
    ids = spark.createDataFrame([("hot",)], "id string")
    small = plan_of(flag_members(frame, "key", ids, "known", SMALL))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    large = plan_of(flag_members(frame, "key", ids, "known", SHUFFLED))
    for plan in (small, large):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_frequent_keys_do_not_meet_in_one_task(spark):
    """A third of the rows has one key; the join on that key must not bring them together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        frame = spark.range(0, 24_000, numPartitions=40).select(key.alias("key"), "id")
        ids = spark.createDataFrame([("hot",), ("k1",)], "member string")
        found = flag_members(frame, "key", ids, "known", SHUFFLED).withColumn("task", F.spark_partition_id())
        assert re.search(r"SortMergeJoin \[key#\d+, _spread#\d+L?\], \[_member#\d+, _zero#\d+L?\]", plan_of(found))
        tasks = [row["rows"] for row in found.groupBy("task", "known").agg(F.count("*").alias("rows")).collect()]
        assert sum(tasks) == 24_000 and max(tasks) < 2_000
        assert found.where("known").count() == 8_001
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("orphan", [True, False], ids=["few orphans", "few members"])
def test_rows_stay_where_they_are_when_few_keys_tell(spark, orphan):
    """More members than may be broadcast: keys are shuffled, rows of many columns are not."""
    key = F.when(F.col("id") % 1000 == 7, "odd").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    wide = spark.range(0, 20_000, numPartitions=9).select(key.alias("key"), "id", *[F.lit(at).alias(f"c{at}") for at in range(21)])
    known = [(f"k{at}" if orphan else f"m{at}",) for at in range(60)] + ([] if orphan else [("odd",)])
    ids = spark.createDataFrame(known, "id string")
    found = flag_members(wide, "key", ids, "known", ANSWERED)
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert found.where("known").count() == (20_000 - 20 if orphan else 20)
    assert found.columns == [*wide.columns, "known"]


def test_lists_are_taken_apart_once_when_ids_are_many(spark):
    parts = spark.createDataFrame([("a,b",)] * 50 + [("a,x",)] * 50 + [(None,)], "qualified_supplier_ids string")
    ids = spark.createDataFrame([(one,) for one in "abcdefgh"], "id string")
    for limits in (SMALL, ANSWERED, SHUFFLED):
        assert rows_of(references.lists_with_orphans(parts, "qualified_supplier_ids", ids, limits)) == [("a,x",)]


def test_measure(spark):
    size = measure(spark.createDataFrame([("abc",), ("é",), (None,)], "v string"))
    assert (size.rows, size.bytes) == (3, 5)
    assert not size.fits(Limits(broadcast_rows=2)) and not size.fits(Limits(broadcast_bytes=4))


PART_SCHEMA = (
    "part_id string, tenant_id string, part_number string, category string, default_supplier_id string, "
    "qualified_supplier_ids string, unit_cost double, moq int, lead_time_days_avg int, lifecycle_status string"
)


def random_parts(count=400):
    draw = random.Random(11)
    ids = [f"s{at}" for at in range(12)]

    def listed():
        chosen = [draw.choice(ids) for _ in range(draw.randint(0, 3))]
        style = draw.randint(0, 4)
        if style == 0:
            return None
        if style == 1:
            return "[" + ", ".join(f'"{item}"' for item in chosen) + "]"
        if style == 2:
            return "['" + "','".join(chosen) + "']"
        return " , ".join(chosen) + draw.choice(["", ",", "\t"])

    return [
        (
            draw.choice([None, "p1", f"p{at}"]),
            draw.choice([None, "t", "t", "t"]),
            draw.choice([None, "n", "n", "n"]),
            draw.choice([None, "BOGUS", "OTHER", "OTHER"]),
            draw.choice([None, "", " s1", *ids]),
            listed(),
            draw.choice([None, -1.0, 2.0]),
            draw.choice([None, -1, 2]),
            draw.choice([None, -1, 2]),
            draw.choice([None, "NEW", "GONE"]),
        )
        for at in range(count)
    ]


def expected_codes(row, valid):
    """The rules of parts, said once more in plain Python."""
    part, tenant, number, category, default, text, cost, moq, lead, status = row
    codes = []
    for value, code in (
        (part, "MISSING_PART_ID"), (tenant, "MISSING_TENANT_ID"), (number, "MISSING_PART_NUMBER"),
        (category, "MISSING_CATEGORY"),
    ):
        if value is None:
            codes.append(code)
    if default is None or default == "":
        codes.append("MISSING_DEFAULT_SUPPLIER")
    elif default not in valid:
        codes.append("ORPHAN_DEFAULT_SUPPLIER")
    bare = text or ""
    if bare[:1] == "[":
        bare = "".join(letter for letter in bare.strip("[]") if letter not in "\"'")
    wanted = {item.strip() for item in bare.split(",")} - {""}
    if wanted - set(valid):
        codes.append("ORPHAN_QUALIFIED_SUPPLIER")
    for value, code in ((cost, "NEGATIVE_UNIT_COST"), (moq, "NEGATIVE_MOQ"), (lead, "NEGATIVE_LEAD_TIME")):
        if value is not None and value < 0:
            codes.append(code)
    if category not in (None, "ELECTRICAL", "MECHANICAL", "RAW_MATERIAL", "OTHER"):
        codes.append("INVALID_CATEGORY")
    if status not in (None, "NEW", "ACTIVE", "NRND", "EOL"):
        codes.append("INVALID_LIFECYCLE_STATUS")
    return codes


@BOTH
@pytest.mark.parametrize("stage", [False, True])
def test_tag_parts_against_brute_force(spark, limits, stage):
    rows = random_parts()
    valid = ["s0", "s1", "s2", "s3", "s4", "s5", "s6", "s7", "s7"]
    parts = spark.createDataFrame(rows, PART_SCHEMA).repartition(5)
    ids = spark.createDataFrame([(value,) for value in valid], "supplier_id string")
    tagged = references.tag_parts(parts, ids, limits=limits, stage=stage)
    assert "Python" not in plan_of(tagged)
    found = sorted([(*row[:10], row["dq_violations"]) for row in tagged.collect()], key=repr)
    assert found == sorted([(*row, expected_codes(row, valid)) for row in rows], key=repr)


def test_array_lists(spark):
    """A real array is read as a list, or refused when text is demanded."""
    rows = [("p1", "s1", ["s1", "s9"]), ("p2", "s1", ["s1"]), ("p3", "s1", []), ("p4", "s1", None)]
    parts = (
        spark.createDataFrame(rows, "part_id string, default_supplier_id string, qualified_supplier_ids array<string>")
        .withColumns({name: F.lit("t") for name in ("tenant_id", "part_number")})
        .withColumns({"category": F.lit("OTHER"), "lifecycle_status": F.lit("NEW")})
        .withColumns({name: F.lit(1) for name in ("unit_cost", "moq", "lead_time_days_avg")})
    )
    ids = spark.createDataFrame([("s1",)], "supplier_id string")
    codes = F.array_join("dq_violations", ",")
    assert rows_of(references.tag_parts(parts, ids), "part_id", codes) == [
        ("p1", "ORPHAN_QUALIFIED_SUPPLIER"), ("p2", ""), ("p3", ""), ("p4", ""),
    ]
    assert rows_of(references.tag_parts(parts, ids, strict_text=True), "part_id", codes) == [
        ("p1", "INVALID_QUALIFIED_SUPPLIER_FORMAT"), ("p2", "INVALID_QUALIFIED_SUPPLIER_FORMAT"),
        ("p3", ""), ("p4", ""),
    ]


def test_accept_children(spark):
    children = spark.createDataFrame([("a",), ("b",), (None,)], "fk string")
    parents = spark.createDataFrame([("a",)], "id string")
    assert rows_of(references.accept_children(children, "fk", parents)) == [("a",), (None,)]


def test_valid_ids_need_no_collect(spark):
    tagged = spark.createDataFrame([("a", True), ("b", False)], "supplier_id string, is_valid boolean")
    assert rows_of(rules.valid_ids(tagged)) == [("a",)]


BASE = [("1", "a", 10.0, "x"), ("2", "b", 20.0, "x"), ("3", "c", 30.0, "x")]
BATCH = [("2", "B", None, "y"), ("3", "C", 31.0, "y"), ("4", "D", 40.0, "y")]
COLUMNS = "id string, name string, score double, note string"


@BOTH
def test_upsert_update(spark, limits):
    base, batch = spark.createDataFrame(BASE, COLUMNS), spark.createDataFrame(BATCH, COLUMNS)
    merged = merge.upsert_update(base, batch, "id", ["score", "name"], limits)
    assert merged.columns == base.columns
    assert rows_of(merged) == [
        ("1", "a", 10.0, "x"), ("2", "B", None, "x"), ("3", "C", 31.0, "x"), ("4", "D", 40.0, "y"),
    ]


def test_upsert_update_refuses_repeated_keys(spark):
    base = spark.createDataFrame(BASE, COLUMNS)
    batch = spark.createDataFrame([BATCH[0], BATCH[0]], COLUMNS)
    with pytest.raises(merge.RepeatedKeyError):
        merge.upsert_update(base, batch, "id", ["score"])


@BOTH
def test_upsert_ignore(spark, limits):
    base = spark.createDataFrame(BASE, COLUMNS)
    batch = spark.createDataFrame([*BATCH, ("4", "A", 1.0, "z")], COLUMNS)
    assert rows_of(merge.upsert_ignore(base, batch, "id", limits)) == [*BASE, ("4", "A", 1.0, "z")]


def test_dedupe_latest(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "x"), (None, 1, "p"), (None, 5, "q")]
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    found = merge.dedupe_latest(frame, ["k"], "t", ["v"])
    # Each task keeps one row per key before anything is moved.
    plan = plan_of(found)
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange") > plan.index("WindowGroupLimit")
    assert rows_of(found) == [("a", 3, "z"), ("b", 2, "x"), (None, 5, "q")]


@BOTH
@pytest.mark.parametrize("stage", [False, True])
def test_flag_duplicates(spark, limits, stage):
    rows = [("t", "a"), ("t", "a"), ("u", "a"), ("t", None), ("t", None), ("t", "b")]
    frame = spark.createDataFrame(rows, "tenant string, code string")
    found = merge.flag_duplicates(frame, ["tenant", "code"], "dup", limits, stage)
    assert rows_of(found) == sorted([(*row, row == ("t", "a")) for row in rows], key=repr)


def test_concat_runs(spark):
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    two = spark.createDataFrame([(2,), (2,)], "id int")
    assert rows_of(merge.concat_runs([one, two])) == [(1, "a"), (2, None), (2, None)]


def test_incremental_rows(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    assert rows_of(merge.incremental_rows(source, source.where("t <= 2"), "t")) == [(3,)]
    assert rows_of(merge.incremental_rows(source, source.where("t < 0"), "t")) == [(1,), (2,), (3,)]
