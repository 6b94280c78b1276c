"""Synthetic tables: distributions, repeatability, references, exact damage."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.draws import Draws
from clearlot.operators import checks, dirt, metrics, references, rules, synth
from clearlot.plans import dataset
from clearlot.session import session_setting, staged

AS_OF = "2025-01-01 00:00:00"
ROWS = 20_000


@pytest.fixture(scope="module")
def suppliers(spark):
    return synth.synth_suppliers(spark.range(ROWS), as_of=AS_OF).cache()


@pytest.fixture(scope="module")
def parts(spark):
    return synth.synth_parts(spark.range(ROWS), ROWS, as_of=AS_OF).cache()


def test_contract_columns(suppliers, parts):
    assert suppliers.columns == C.columns(C.SUPPLIERS) and len(suppliers.columns) == 33
    assert parts.columns == C.columns(C.PARTS) and len(parts.columns) == 23


def test_no_rows_and_no_parents(spark):
    assert synth.synth_suppliers(spark.range(0)).count() == 0
    with pytest.raises(ValueError):
        synth.synth_parts(spark.range(3), 0)
    with pytest.raises(ValueError):
        synth.synth_parts(spark.range(3), spark.createDataFrame([], "supplier_id string"))
    with pytest.raises(ValueError):
        dataset.make_dataset(spark, 0, 1)


def test_partitioning_does_not_matter(spark):
    for variant in (synth.FULL, synth.FAST):
        made = []
        for tasks in (1, 4, 16):
            frame = synth.synth_suppliers(spark.range(0, 200, numPartitions=tasks), as_of=AS_OF, variant=variant)
            damaged = dirt.inject_anomalies(frame, C.SUPPLIERS, 0.2, as_of=AS_OF, fast=variant == synth.FAST)
            made.append(rows_of(damaged))
        assert made[0] == made[1] == made[2]


def test_seed_matters(spark):
    one, two = (rows_of(synth.synth_suppliers(spark.range(5), seed=seed, as_of=AS_OF)) for seed in (1, 2))
    assert one != two


@pytest.mark.parametrize(
    "column, expected",
    [
        ("country", {key: weight / 100 for key, weight in synth.COUNTRY_WEIGHTS.items()}),
        ("approved_status", synth.STATUS_WEIGHTS),
    ],
)
def test_supplier_shares(suppliers, column, expected):
    assert all(row["within"] for row in metrics.share_against_spec(suppliers, column, expected, 0.015).collect())


@pytest.mark.parametrize(
    "column, expected",
    [
        ("category", synth.CATEGORY_WEIGHTS),
        ("lifecycle_status", synth.LIFECYCLE_WEIGHTS),
        ("uom", synth.UNIT_WEIGHTS),
        ("quality_grade", synth.GRADE_WEIGHTS),
    ],
)
def test_part_shares(parts, column, expected):
    assert all(row["within"] for row in metrics.share_against_spec(parts, column, expected, 0.015).collect())


def test_top_countries(suppliers):
    assert [row["country"] for row in metrics.top_values(suppliers, "country", 2).collect()] == ["CN", "US"]


def test_moments(suppliers, parts):
    row = suppliers.agg(
        F.avg("on_time_delivery_rate").alias("rate"),
        F.stddev("lead_time_days_avg").alias("lead_deviation"),
        F.corr("on_time_delivery_rate", "risk_score").alias("correlation"),
        F.avg("defect_rate_ppm").alias("defects"),
    ).first()
    assert 92 < row["rate"] < 93.5 and 5.7 < row["lead_deviation"] < 6.3 and row["correlation"] < -0.3
    assert 240 < row["defects"] < 280
    cost = parts.agg(F.avg(F.log("unit_cost")).alias("mean"), F.stddev(F.log("unit_cost")).alias("deviation")).first()
    assert 2.97 < cost["mean"] < 3.03 and 0.77 < cost["deviation"] < 0.83
    leads = {row["category"]: row["average"] for row in metrics.average_by(parts, "category", "lead_time_days_avg").collect()}
    for category, (mean, _) in synth.CATEGORY_LEAD_TIMES.items():
        assert mean - 1 < leads[category] < mean


def test_first_certification_follows_weights(suppliers):
    """Weighted draws without replacement: the first pick has the plain weights."""
    first = suppliers.select(F.element_at("certifications", 1).alias("first"))
    total = sum(synth.CERTIFICATION_WEIGHTS)
    expected = {name: weight / total for name, weight in zip(C.CERTIFICATIONS, synth.CERTIFICATION_WEIGHTS)}
    assert all(row["within"] for row in metrics.share_against_spec(first, "first", expected, 0.015).collect())


def test_lists_and_ids(suppliers, parts):
    assert checks.outside_domain(suppliers, "certifications", C.CERTIFICATIONS).count() == 0
    assert checks.outside_domain(parts, "compliance_flags", C.COMPLIANCE_FLAGS).count() == 0
    for frame, key in ((suppliers, "supplier_id"), (parts, "part_id")):
        assert rows_of(checks.id_shape(frame, key)) == [(ROWS, ROWS)]
        assert rows_of(metrics.duplicate_surplus(frame, [key]), "surplus") == [(0,)]
    assert rows_of(metrics.tier_disagreements(suppliers)) == [(ROWS, 0)]
    found = checks.timestamp_shape(parts, ["source_timestamp", "ingestion_timestamp", "last_price_change"])
    assert all(row["filled"] == row["readable"] == ROWS for row in found.collect())


def test_approximate_surplus(suppliers):
    (row,) = metrics.approximate_surplus(suppliers, ["supplier_id"]).collect()
    assert row["rows"] == ROWS and abs(row["distinct_values"] - ROWS) < 0.06 * ROWS


def test_references_hold(suppliers, parts):
    ids = suppliers.select("supplier_id")
    assert references.orphan_defaults(parts, ids).count() == 0
    assert references.orphan_list_members(parts, ids).count() == 0
    assert references.default_in_list(parts).where("NOT default_in_list").count() == 0


def test_parents_from_a_table(spark):
    """Few parents: lists never repeat one and are no longer than there are parents."""
    for count in (1, 2, 3):
        parents = spark.createDataFrame([(f"s{at}",) for at in range(count)], "supplier_id string")
        made = synth.synth_parts(spark.range(300), parents, as_of=AS_OF)
        listed = F.col("qualified_supplier_ids")
        row = made.agg(
            F.count("*").alias("rows"),
            F.max(F.size(listed)).alias("longest"),
            F.count_if(F.size(F.array_distinct(listed)) < F.size(listed)).alias("repeating"),
            F.count_distinct("default_supplier_id").alias("used"),
        ).first()
        assert tuple(row) == (300, count, 0, count)


def test_number_rows(spark):
    keys = [f"k{at}" for at in range(500)]
    frame = spark.createDataFrame([(key,) for key in keys], "k string")
    one = rows_of(synth.number_rows(frame.repartition(3), "k"))
    assert one == rows_of(synth.number_rows(frame.repartition(11), "k"))
    assert sorted(number for _, number in one) == list(range(500))


@pytest.mark.parametrize("rate", [0.0, 0.001, 0.06, 0.5, 1.0])
def test_sample_is_exact(spark, rate):
    frame = spark.range(1234)
    for tasks in (2, 7):
        picked = dirt.sample_rows(frame.repartition(tasks), "id", rate, seed=3)
        assert picked.count() == picked.distinct().count() == int(1234 * rate)


def test_sample_against_sorting(spark):
    frame = spark.range(1000)
    wanted = sorted(
        (row["h"], row["id"]) for row in frame.select(F.xxhash64("id", F.lit(3), F.lit("sample")).alias("h"), "id").collect()
    )[:60]
    assert rows_of(dirt.sample_rows(frame, "id", 0.06, seed=3)) == sorted(((number,) for _, number in wanted), key=repr)


def test_supplier_damage(spark, suppliers):
    damaged = dirt.inject_anomalies(suppliers, C.SUPPLIERS, 0.06, as_of=AS_OF)
    assert damaged.columns == suppliers.columns and damaged.count() == ROWS
    counts = {row["kind"]: row["rows"] for row in metrics.anomaly_counts(
        damaged, metrics.supplier_anomalies(F.lit(AS_OF).cast("timestamp"))).collect()}
    before = suppliers.select(F.col("supplier_id").alias("id"), F.col("supplier_code").alias("code"))
    recoded = damaged.join(before, F.col("supplier_id") == F.col("id")).where("supplier_code <> code")
    counts["duplicate_code"] = recoded.count()
    assert sum(counts.values()) == int(ROWS * 0.06)
    assert all(180 < count < 300 for count in counts.values())
    # Every copied code belongs to another row of the undamaged table.
    assert recoded.select("supplier_code").join(before, F.col("supplier_code") == F.col("code"), "left_anti").count() == 0
    # Two of five kinds are seen by the rules.
    rate = metrics.validation_metrics(rules.tag_suppliers(damaged)).first()["pass_rate"]
    assert 97.2 < rate < 98.0


def test_part_damage(suppliers, parts):
    damaged = dirt.inject_anomalies(parts, C.PARTS, 0.06, as_of=AS_OF)
    assert damaged.columns == parts.columns and damaged.dtypes == parts.dtypes
    tests = metrics.part_anomalies(F.lit(AS_OF).cast("timestamp"), C.UNITS)
    counts = {row["kind"]: row["rows"] for row in metrics.anomaly_counts(damaged, tests).collect()}
    strangers = references.orphan_defaults(damaged, suppliers.select("supplier_id"))
    assert strangers.where(F.col("qualified_supplier_ids") != F.array("default_supplier_id")).count() == 0
    before = parts.select(F.col("part_id").alias("id"), F.col("part_number").alias("number"))
    counts["copied"] = damaged.join(before, F.col("part_id") == F.col("id")).where("part_number <> number").count()
    counts["strangers"] = strangers.count()
    assert sum(counts.values()) == int(ROWS * 0.06)


def test_damage_of_chosen_kinds(spark, suppliers):
    damaged = dirt.inject_anomalies(suppliers, C.SUPPLIERS, 0.1, kinds=["bogus_country"], as_of=AS_OF)
    assert damaged.where("country = 'XX'").count() == int(ROWS * 0.1)
    with pytest.raises(ValueError):
        dirt.inject_anomalies(suppliers, "orders", 0.1)


def test_one_damaged_row_still_finds_a_donor(spark):
    frame = synth.synth_suppliers(spark.range(20), as_of=AS_OF)
    damaged = dirt.inject_anomalies(frame, C.SUPPLIERS, 0.05, kinds=["duplicate_code"], as_of=AS_OF)
    assert damaged.groupBy("supplier_code").count().where("count = 2").count() == 1


def test_draws(spark):
    draw = Draws(F.col("id"), 9)
    row = spark.range(20_000).agg(
        F.min(draw.uniform("u")).alias("low"),
        F.max(draw.uniform("u")).alias("high"),
        F.avg(draw.normal("n", 10, 2)).alias("mean"),
        F.stddev(draw.normal("n", 10, 2)).alias("deviation"),
        F.collect_set(draw.whole("w", 3, 6)).alias("whole"),
    ).first()
    assert 0 <= row["low"] < 0.001 and 0.999 < row["high"] < 1
    assert abs(row["mean"] - 10) < 0.06 and abs(row["deviation"] - 2) < 0.04
    assert sorted(row["whole"]) == [3, 4, 5, 6]


def test_ids_of_one_split_are_made_by_many_tasks(spark):
    ids = spark.range(2_000).coalesce(1)
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b"):
        made = staged(dataset.make_dataset(spark, ids, 10, as_of="2024-01-31T00:00:00Z").suppliers, "made")
    assert made.select(F.input_file_name()).distinct().count() > 1
    assert made.count() == 2_000


def test_a_sample_makes_its_frame_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def noted(number):
        seen.add(1)
        return number

    frame = spark.range(500).withColumn("id", F.udf(noted, "long")("id"))
    condition = dirt.exact_sample(frame, "id", 0.1, 7)
    assert seen.value == 500
    assert spark.range(500).where(condition).count() == 50


@pytest.mark.parametrize("kinds", [("negative_cost",), ("duplicate_part_number",), None])
def test_rows_drawn_once_serve_several_kinds(spark, kinds):
    made = staged(synth.synth_parts(spark.range(300), 40, as_of=AS_OF), "parts")
    drawn = dirt.exact_sample(made, "part_id", 0.1, 42)
    once = dirt.inject_anomalies(made, C.PARTS, 0.1, kinds=kinds, as_of=AS_OF, chosen=drawn)
    assert rows_of(once) == rows_of(dirt.inject_anomalies(made, C.PARTS, 0.1, kinds=kinds, as_of=AS_OF))
