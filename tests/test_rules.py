"""Rules fire on TRUE only, in a fixed order."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.operators import metrics, rules

GOOD_SUPPLIER = dict(
    supplier_id="A", tenant_id="t", legal_name="n", on_time_delivery_rate=90.0, risk_score=10.0, lead_time_days_avg=5,
    defect_rate_ppm=1, financial_risk_tier="LOW", approved_status="APPROVED", country="US",
)
SCHEMA = (
    "supplier_id string, tenant_id string, legal_name string, on_time_delivery_rate double, risk_score double, "
    "lead_time_days_avg int, defect_rate_ppm int, financial_risk_tier string, approved_status string, country string"
)


def violations(spark, **changes):
    row = {**GOOD_SUPPLIER, **changes}
    frame = spark.createDataFrame([tuple(row.values())], SCHEMA)
    tagged = rules.tag_suppliers(frame).first()
    assert tagged["is_valid"] == (not tagged["dq_violations"])
    return tagged["dq_violations"]


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"supplier_id": None}, ["MISSING_SUPPLIER_ID"]),
        ({"tenant_id": None}, ["MISSING_TENANT_ID"]),
        ({"legal_name": None}, ["MISSING_LEGAL_NAME"]),
        ({"legal_name": ""}, []),
        ({"on_time_delivery_rate": 104.0}, ["INVALID_ON_TIME_RATE"]),
        ({"on_time_delivery_rate": -0.1}, ["INVALID_ON_TIME_RATE"]),
        ({"on_time_delivery_rate": 100.0}, []),
        ({"on_time_delivery_rate": None}, []),
        ({"risk_score": float("nan")}, ["INVALID_RISK_SCORE"]),
        ({"risk_score": None}, []),
        ({"lead_time_days_avg": -1}, ["NEGATIVE_LEAD_TIME"]),
        ({"defect_rate_ppm": -1}, ["NEGATIVE_DEFECT_RATE"]),
        ({"financial_risk_tier": "BAD"}, ["INVALID_FINANCIAL_TIER"]),
        ({"financial_risk_tier": ""}, ["INVALID_FINANCIAL_TIER"]),
        ({"financial_risk_tier": None}, []),
        ({"approved_status": "approved"}, ["INVALID_STATUS"]),
        ({"country": "USA"}, ["INVALID_COUNTRY_CODE"]),
        ({"country": "XX"}, ["INVALID_COUNTRY_CODE"]),
        ({"country": None}, []),
        (
            {"country": "XX", "supplier_id": None, "risk_score": 101.0},
            ["MISSING_SUPPLIER_ID", "INVALID_RISK_SCORE", "INVALID_COUNTRY_CODE"],
        ),
    ],
)
def test_supplier_rules(spark, changes, expected):
    assert violations(spark, **changes) == expected


def test_text_numbers_do_not_fail(spark):
    """Rules on a table whose numbers are still text: unreadable ones pass, like NULL."""
    names = ("on_time_delivery_rate", "risk_score", "lead_time_days_avg", "defect_rate_ppm")
    for text, expected in (("abc", []), ("", []), ("-1", 4)):
        frame = spark.createDataFrame([tuple(GOOD_SUPPLIER.values())], SCHEMA).withColumns(
            {name: F.lit(text) for name in names}
        )
        found = rules.tag_suppliers(frame).first()["dq_violations"]
        assert found == expected or len(found) == expected


def test_rule_counts(spark):
    assert len(rules.supplier_rules()) == 10
    assert len(rules.part_key_rules()) + len(rules.part_value_rules()) == 9


def test_optional_rules(spark):
    frame = spark.createDataFrame([("EA", "2024-01-02"), ("BOX", "2024-03-01"), (None, None)], "uom string, source_timestamp string")
    found = rules.tag(
        frame,
        [*rules.domain_rules(C.PARTS, ["uom"]), rules.freshness_rule(F.lit("2024-02-01").cast("timestamp"))],
    )
    assert rows_of(found, F.array_join("dq_violations", ",")) == [("",), ("",), ("INVALID_UOM,FUTURE_SOURCE_TIMESTAMP",)]


def test_rates_without_rows(spark):
    empty = spark.createDataFrame([], "is_valid boolean, dq_violations array<string>")
    assert rows_of(metrics.validation_metrics(empty)) == [(0, 0, 0.0)]
    both = [metrics.validation_metrics(empty), metrics.validation_metrics(empty)]
    assert rows_of(metrics.overall_pass_rate(*both)) == [(0, 0, 0.0)]
    assert rows_of(metrics.quality_gate(metrics.validation_metrics(empty)), "passed") == [(False,)]


def test_violation_counts_count_a_row_once_per_code(spark):
    frame = spark.createDataFrame([(["A", "B"],), (["A"],), ([],)], "dq_violations array<string>")
    assert rows_of(metrics.violation_counts(frame)) == [("A", 2), ("B", 1)]
