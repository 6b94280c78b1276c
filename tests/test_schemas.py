"""Types that runs of a date may mix, and how many jobs it takes to learn them."""

import itertools
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearlot.sources import landing, schemas


def kind(text):
    return T.StructType.fromDDL(f"c {text}")["c"].dataType


@pytest.mark.parametrize(
    "kinds, wanted",
    [
        (["int"], "int"), (["int", "bigint"], "bigint"), (["smallint", "int"], "int"), (["int", "double"], "double"),
        (["float", "smallint"], "double"), (["bigint", "double"], "string"), (["int", "bigint", "double"], "string"),
        (["int", "decimal(18,6)"], "decimal(18,6)"), (["bigint", "decimal(18,6)"], "decimal(25,6)"),
        (["decimal(10,2)", "decimal(8,4)"], "decimal(12,4)"), (["decimal(38,0)", "decimal(38,20)"], "string"),
        (["decimal(18,6)", "double"], "string"), (["date", "timestamp"], "timestamp"), (["void", "int"], "int"),
        (["string", "int"], "string"), (["array<string>", "string"], "string"), (["boolean", "int"], "string"),
        (["struct<lat:double>", "string"], "string"),
    ],
)
def test_widest_type_does_not_depend_on_order(spark, kinds, wanted):
    for order in itertools.permutations(kinds):
        assert schemas.widest([kind(one) for one in order]).simpleString() == wanted


def test_values_survive_as_text(spark):
    rows = [(1.2345678e7, 3.5), (1e-4, 0.0), (-0.5, 100.0), (1e300, None), (1e-30, 20.0), (float("nan"), 1e15)]
    frame = spark.createDataFrame(rows, "a double, b double")
    text = {"a": ["12345678", "0.0001", "-0.5", "1.0E300", "1.0E-30", "NaN"], "b": ["3.5", "0", "100", None, "20", "1000000000000000"]}
    for name, wanted in text.items():
        assert [row[0] for row in frame.select(schemas.plain_number(F.col(name))).collect()] == wanted
    odd = spark.sql("SELECT array(1, 2) AS a, named_struct('lat', 1.5D, 'lon', CAST(NULL AS DOUBLE)) AS s, map('k', 1) AS m")
    made = odd.select(*[schemas.as_type(F.col(f.name), f.dataType, T.StringType()) for f in odd.schema.fields]).first()
    assert tuple(made) == ("1,2", '{"lat":1.5,"lon":null}', '{"k":1}')


def _jobs(spark, work, name):
    spark.sparkContext.setJobGroup(name, name)
    try:
        found = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_thousand_runs_take_one_job(spark, tmp_path):
    for at in range(1000):
        path = tmp_path / f"processed/ten ant/parts/2024-01-31/20240131_{at:06d}"
        os.makedirs(path)
        values = {"part_id": pa.array(["p"]), "moq": pa.array([at], pa.int32() if at % 3 else pa.float64())}
        if at == 5:
            values["more"] = pa.array([True])
        pq.write_table(pa.table(values), path / "parts.parquet")
    where = (spark, str(tmp_path), "ten ant", "parts", "2024-01-31")
    found, jobs = _jobs(spark, lambda: landing.landed_schemas(*where), "footers")
    assert len(found) == 1000 and jobs <= 2  # the second lists the files
    runs, jobs = _jobs(spark, lambda: landing.read_runs(*where, found), "reading")
    assert jobs <= 3  # a listing for each of the schemas, whatever the number of runs
    assert dict(runs.dtypes)["moq"] == "double"
    assert tuple(runs.agg(F.count("*"), F.sum("moq"), F.count("more"), F.count_distinct("landing_run_id")).first()) == (
        1000, 499500.0, 1, 1000)
    drift = landing.run_drift(*where, found)
    assert drift.groupBy("field", "type").count().count() == 4 and drift.count() == 2000


def test_files_of_one_run_may_differ(spark, tmp_path):
    path = tmp_path / "processed/t/parts/2024-01-31/20240131_060000/parts.parquet"
    os.makedirs(path)
    pq.write_table(pa.table({"moq": pa.array([1], pa.int32())}), path / "part-0.parquet")
    pq.write_table(pa.table({"moq": pa.array([2], pa.int64()), "uom": ["EA"]}), path / "part-1.parquet")
    where = (spark, str(tmp_path), "t", "parts", "2024-01-31")
    assert sorted(tuple(row) for row in landing.read_runs(*where).select("moq", "uom").collect()) == [(1, None), (2, "EA")]
    assert landing.run_drift(*where).collect() == []


def test_spark_is_asked_where_tasks_cannot_open_a_file(spark, tmp_path, monkeypatch):
    spark.range(3).withColumn("d", F.lit(1.5).cast("decimal(9,2)")).write.parquet(f"{tmp_path}/x")
    plain = schemas.schemas_by_file(spark, f"{tmp_path}/x")
    monkeypatch.setattr(schemas, "file_schemas", lambda s, p: s.createDataFrame([(one, None) for one in plain], "path string, schema string"))
    asked = schemas.schemas_by_file(spark, f"{tmp_path}/x")
    assert {p: s.simpleString() for p, s in asked.items()} == {p: s.simpleString() for p, s in plain.items()}
    assert json.loads(next(iter(plain.values())).json())["fields"][1]["type"] == "decimal(9,2)"


def test_nothing_landed(spark, tmp_path):
    with pytest.raises(AnalysisException):
        landing.read_runs(spark, str(tmp_path), "t", "parts", "2024-01-31")
    assert landing.read_or_none(lambda: landing.read_runs(spark, str(tmp_path), "t", "parts", "2024-01-31")) is None
