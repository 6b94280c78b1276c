"""Text lists, text numbers, geo coordinates and swapped columns."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions import lists as L
from clearlot.functions.lookups import base_risk, derive_currency, derive_region, is_record_id, risk_tier
from clearlot.operators import clean


@pytest.mark.parametrize(
    "text, expected",
    [
        ('["a", "b"]', ["a", "b"]),
        ("['a','b']", ["a", "b"]),
        ("a, b,", ["a", "b"]),
        ("", []),
        (None, None),
        ("[]", []),
        ("\ta ,\n b\r", ["a", "b"]),
        (" a ,　b\u0085", ["a", "b"]),
        ("a b,c", ["a b", "c"]),
        ("[[a]]", ["a"]),
        ("a],b", ["a]", "b"]),
        ("'a'", ["'a'"]),
        (" [a]", ["[a]"]),
    ],
)
def test_text_to_list(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "v string")
    assert frame.select(L.text_to_list(F.col("v"))).first()[0] == expected


def test_text_to_list_against_plain_python(spark):
    """Thousands of odd texts in one job, next to the same reading said in Python."""
    draw = random.Random(3)
    letters = "[]'\", ,ab\t\n\u00a0\u3000\u200b\x1cé"
    texts = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(0, 9))) for _ in range(6000)})

    def read(text):
        if text[:1] == "[":
            text = text.strip("[]")
            text = "".join(letter for letter in text if letter not in "\"'")
        return [item for item in map(str.strip, text.split(",")) if item]

    frame = spark.createDataFrame([(text,) for text in texts], "v string").repartition(8)
    found = frame.select("v", L.text_to_list(F.col("v")).alias("items")).collect()
    assert len(found) == len(texts)
    assert [row["v"] for row in found if row["items"] != read(row["v"])] == []


def test_list_to_text_and_json(spark):
    frame = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "v array<string>")
    out = frame.select(L.list_to_text(F.col("v")), L.list_to_json(F.col("v")))
    assert [tuple(row) for row in out.collect()] == [("a,b", '["a","b"]'), ("", None), ("", None)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("12", 12),
        ("12.5", 12),
        ("-3.9", -3),
        (" 7 ", 7),
        ("+4", 4),
        ("99999999999", None),
        ("abc", None),
        ("", None),
        ("1e3", None),
        (None, None),
    ],
)
def test_whole_number_from_text(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "moq string")
    assert clean.cast_contract(frame, C.PARTS).first()[0] == expected


def test_cast_contract_types(spark):
    frame = spark.createDataFrame([("1.5", 3.7, "x")], "unit_cost string, moq double, other string")
    cast = clean.cast_contract(frame, C.PARTS)
    assert cast.dtypes == [("unit_cost", "decimal(18,6)"), ("moq", "int"), ("other", "string")]
    assert [str(value) for value in cast.first()] == ["1.500000", "3", "x"]


@pytest.mark.parametrize(
    "geo, source, expected",
    [
        ('{"lat": 1.5, "lon": -2}', "synthetic.v1", (1.5, -2.0)),
        ('{"lat": null, "lon": null}', "synthetic.v1", (None, None)),
        ("", "synthetic.v1", (None, None)),
        (None, "synthetic.v1", (None, None)),
        (None, '{"lat": 3.25, "lon": -4.5}', (3.25, -4.5)),
        (None, "lat lon", (None, None)),
        ('{"lat": 1.5, "lon": -2}', None, (1.5, -2.0)),
        ('{"lat": 1.5, "lon": -2}', '{"lat": 3.25, "lon": -4.5}', (3.25, -4.5)),
        ("no json", "synthetic.v1", (None, None)),
    ],
)
def test_repair_geo(spark, geo, source, expected):
    frame = spark.createDataFrame([(geo, source)], "geo_coords string, data_source string")
    found = clean.repair_geo(frame).first()["geo_coords"]
    assert found is not None and tuple(found) == expected


def test_repair_geo_joins_split_columns(spark):
    frame = spark.createDataFrame([(1.0, 2.0, "s")], "geo_lat double, geo_lon double, data_source string")
    repaired = clean.repair_geo(frame)
    assert tuple(repaired.first()["geo_coords"]) == (1.0, 2.0)
    assert clean.repair_geo(repaired).dtypes == repaired.dtypes


SWAPPED = [("S123456", "tenant_a"), ("S654321", "tenant_b"), (None, "tenant_c"), ("", "tenant_d")]


def test_repair_swap_exchanges_the_whole_table(spark):
    frame = spark.createDataFrame(SWAPPED, "tenant_id string, supplier_code string")
    expected = sorted([(code, tenant) for tenant, code in SWAPPED], key=repr)
    assert rows_of(clean.repair_swap(frame, C.SUPPLIERS)) == expected


@pytest.mark.parametrize("rows", [[("tenant_a", "S123456")], [("Sunrise", "S123456")], [(None, "S1")], []])
def test_repair_swap_leaves_sound_tables(spark, rows):
    frame = spark.createDataFrame(rows, "tenant_id string, supplier_code string")
    assert rows_of(clean.repair_swap(frame, C.SUPPLIERS)) == rows


def test_repair_swap_any_prefix(spark):
    frame = spark.createDataFrame([("P-1", "t"), ("x", "y"), ("z", "w")], "tenant_id string, part_number string")
    repaired = clean.repair_swap(frame, C.PARTS, pattern="^P-", min_share=0.0)
    assert rows_of(repaired) == [("t", "P-1"), ("w", "z"), ("y", "x")]


def test_drop_connector_metadata(spark):
    frame = spark.range(1).withColumn("_airbyte_meta", F.lit(1))
    assert clean.drop_connector_metadata(frame).columns == ["id"]


def test_apply_defaults_keeps_nulls(spark):
    frame = spark.createDataFrame([(None,)], "schema_version string")
    row = clean.apply_defaults(frame).first()
    assert row["schema_version"] is None and row["ingestion_timestamp"] is not None


def test_lookups(spark):
    frame = spark.createDataFrame([("US",), ("PL",), ("VN",), ("ZZ",), (None,)], "c string")
    found = frame.select(derive_region(F.col("c")), derive_currency(F.col("c"))).collect()
    assert [tuple(row) for row in found] == [
        ("AMERICAS", "USD"), ("EMEA", "PLN"), ("APAC", "VND"), ("OTHER", "USD"), ("OTHER", "USD"),
    ]


def test_risk_tiers(spark):
    frame = spark.createDataFrame([(-1.0,), (0.0,), (34.99,), (35.0,), (59.9,), (60.0,), (120.0,)], "s double")
    found = frame.select(risk_tier(F.col("s")), risk_tier(F.col("s"), True)).collect()
    assert [row[0] for row in found] == ["HIGH", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert found[0][1] == "LOW"


def test_base_risk(spark):
    frame = spark.createDataFrame([(93.0, 0.0), (104.0, 0.0), (93.0, -20.0), (10.0, 50.0)], "r double, n double")
    found = [row[0] for row in frame.select(base_risk(F.col("r"), F.col("n"))).collect()]
    assert found == [7.0, 0.0, 0.0, 100.0]


def test_record_id_shape(spark):
    frame = spark.createDataFrame([("0" * 26,), ("I" * 26,), ("0" * 25,)], "v string")
    assert [row[0] for row in frame.select(is_record_id(F.col("v"))).collect()] == [True, False, False]
