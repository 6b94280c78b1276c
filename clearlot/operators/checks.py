"""Comparison of a table with its contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.lists import as_list
from clearlot.functions.lookups import is_record_id

# Which kinds of column satisfy the contract's type rules.
TYPE_RULES = {
    C.SUPPLIERS: {
        "on_time_delivery_rate": ("double", "float", "decimal"),
        "risk_score": ("double", "float", "decimal"),
        "lead_time_days_avg": ("int", "bigint", "smallint"),
        "lead_time_days_p95": ("int", "bigint", "smallint"),
        "defect_rate_ppm": ("int", "bigint", "smallint"),
    },
    C.PARTS: {"unit_cost": ("decimal",)},
}


def field_report(frame: DataFrame, entity: str) -> DataFrame:
    """One row per contract field: is it there, with which type, and how many rows fill it. One pass."""
    actual = dict(frame.dtypes)
    fields = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(kind).alias("contract_type"),
            F.lit(actual.get(name, "")).alias("actual_type"),
            F.lit(name in actual).alias("present"),
            F.lit(actual.get(name) == kind).alias("same_type"),
            (F.count(name) if name in actual else F.lit(0).cast("long")).alias("filled"),
        )
        for name, kind in C.CONTRACT[entity].items()
    ]
    return frame.agg(F.count("*"), F.array(*fields).alias("fields")).select(F.inline("fields"))


def field_coverage(frame: DataFrame, entity: str) -> DataFrame:
    """How many contract fields the frame has, which it lacks, and which ones the contract does not know."""
    report = field_report(frame, entity)
    unknown = [name for name in frame.columns if name not in C.CONTRACT[entity]]
    return report.agg(
        F.count("*").alias("fields"),
        F.count_if("present").alias("present"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("present"), F.col("field")))), ",").alias("missing"),
        F.lit(",".join(sorted(unknown))).alias("unknown"),
    )


def type_report(frame: DataFrame, entity: str) -> DataFrame:
    """One row per type rule whose column is present: the rule's answer and the rows it speaks for."""
    actual = dict(frame.dtypes)
    rules = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(actual[name]).alias("actual_type"),
            F.lit(any(actual[name].startswith(kind) for kind in kinds)).alias("accepted"),
            F.count(name).alias("filled"),
        )
        for name, kinds in TYPE_RULES[entity].items()
        if name in actual
    ]
    return frame.agg(F.array(*rules).alias("rules")).select(F.inline("rules"))


def drift_report(frame: DataFrame, entity: str) -> DataFrame:
    """Where the frame departs from the contract: fields missing, of another type, or not in the contract."""
    actual = dict(frame.dtypes)
    known = C.CONTRACT[entity]
    departures = [(name, "missing") for name in known if name not in actual]
    departures += [(name, "type") for name, kind in known.items() if name in actual and actual[name] != kind]
    departures += [(name, "unknown") for name in actual if name not in known]
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(kind).alias("departure"),
            F.lit(actual.get(name, "")).alias("actual_type"),
            (F.count(F.col(name)) if name in actual else F.lit(0).cast("long")).alias("filled"),
        )
        for name, kind in departures
    ]
    none = F.array().cast("array<struct<field:string,departure:string,actual_type:string,filled:bigint>>")
    return frame.agg(F.count("*"), (F.array(*rows) if rows else none).alias("rows")).select(F.inline("rows"))


def geo_shape(frame: DataFrame) -> list[str]:
    """What is wrong with the shape of the geo column."""
    kinds = dict(frame.dtypes)
    problems = []
    if "geo_coords" not in kinds:
        problems.append("geo_coords missing")
    elif not kinds["geo_coords"].startswith("struct"):
        problems.append("geo_coords is no struct")
    elif not {"lat", "lon"} <= set(frame.schema["geo_coords"].dataType.names):
        problems.append("geo_coords lacks lat or lon")
    if "geo_lat" in kinds or "geo_lon" in kinds:
        problems.append("geo_coords is split")
    return problems


def _value_checks(frame: DataFrame, entity: str) -> dict[str, Column]:
    """Conditions of single rows that break the contract."""
    source = F.col("data_source")
    tests = {"data_source holds coordinates": source.contains("{") & source.contains("lat")}
    if entity == C.SUPPLIERS:
        if not geo_shape(frame):
            tests["geo_coords incomplete"] = F.col("geo_coords.lat").isNull() | F.col("geo_coords.lon").isNull()
        for name in ("risk_score", "on_time_delivery_rate"):
            value = F.col(name).try_cast("double")
            tests[f"{name} out of range"] = (value < 0) | (value > 100)
    return tests


def contract_violations(frame: DataFrame, entity: str) -> DataFrame:
    """One row per check with the number of offending rows (or 1 for a fault of the schema).

    All rows are inspected, in one pass.
    """
    names = set(frame.columns)
    actual = dict(frame.dtypes)
    faults = [f"{name} missing" for name in C.CONTRACT[entity] if name not in names]
    if entity == C.SUPPLIERS:
        faults += [problem for problem in geo_shape(frame) if problem != "geo_coords missing"]
    faults += [
        f"{name} has type {actual[name]}"
        for name, kinds in TYPE_RULES[entity].items()
        if name in actual and not any(actual[name].startswith(kind) for kind in kinds)
    ]
    counts = [
        F.struct(F.lit(label).alias("check"), F.count_if(test).alias("rows"))
        for label, test in _value_checks(frame, entity).items()
    ]
    counts += [F.struct(F.lit(fault).alias("check"), F.lit(1).cast("long").alias("rows")) for fault in faults]
    return frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def verdict(violations: DataFrame) -> DataFrame:
    """One row: compliant when no check found anything."""
    return violations.agg(
        F.coalesce(F.bool_and(F.col("rows") == 0), F.lit(True)).alias("compliant"),
        F.count_if(F.col("rows") > 0).alias("failed_checks"),
    )


def id_shape(frame: DataFrame, key: str) -> DataFrame:
    """Rows, and rows whose id is 26 characters of Crockford base 32."""
    return frame.agg(F.count("*").alias("rows"), F.count_if(is_record_id(F.col(key))).alias("well_formed"))


def timestamp_shape(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per text column: filled values and how many of them can be read as a timestamp."""
    counts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("filled"),
            F.count(F.try_to_timestamp(F.col(name))).alias("readable"),
        )
        for name in names
    ]
    return frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def outside_domain(frame: DataFrame, name: str, domain: Sequence[str]) -> DataFrame:
    """Rows of which a list element is not in the domain, with those elements; NULL and empty lists pass."""
    known = F.array(*[F.lit(item) for item in domain])
    return frame.withColumn("unknown_items", F.array_except(as_list(frame, name), known)).where(
        F.size("unknown_items") > 0
    )


def constraint_report(frame: DataFrame, entity: str) -> DataFrame:
    """Rows that the customer database would refuse, per constraint.

    NOT NULL, text length and numeric precision are counted in one pass; the primary key by grouping on it.
    """
    kinds = dict(frame.dtypes)
    tests = {f"{name} is NULL": F.col(name).isNull() for name in C.REQUIRED[entity] if name in kinds}
    for name, length in C.SQL_LENGTHS[entity].items():
        if name in kinds:
            tests[f"{name} longer than {length}"] = F.length(F.col(name)) > length
    for name, (precision, scale) in C.SQL_DECIMALS[entity].items():
        if name in kinds:
            limit = 10 ** (precision - scale)
            tests[f"{name} wider than {precision},{scale}"] = F.abs(F.round(F.col(name).try_cast("double"), scale)) >= limit
    counts = [
        F.struct(F.lit(label).alias("constraint"), F.count_if(test).alias("rows")) for label, test in tests.items()
    ]
    simple = frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    key = C.PRIMARY_KEY[entity]
    repeated = (
        frame.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows"))
        .select(F.lit(f"{key} repeated").alias("constraint"), "rows")
    )
    return simple.unionByName(repeated)
