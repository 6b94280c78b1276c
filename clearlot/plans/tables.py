"""Suppliers and parts derived from star-schema tables (supplier, nation, part, lineitem).

The star-schema tables are clean, so faults are put in by arithmetic on the keys. All rows are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.lookups import derive_currency, derive_region, risk_tier

MOMENT = "2024-01-31T00:00:00.000000Z"


# Known schemas, so that opening a table starts no job to look into its files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _projection(frame: DataFrame, values: dict[str, str]) -> DataFrame:
    return frame.selectExpr(*[f"{value} AS {name}" for name, value in values.items()])


def _key(number: str) -> str:
    return f"concat('S', lpad({number}, 8, '0'))"


def _one_of(options: tuple[str, ...], position: str) -> str:
    return f"element_at(array({', '.join(repr(option) for option in options)}), int({position} + 1))"


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """All 33 columns: numbers typed, lists as comma text, geo as JSON text in one of two columns."""
    k = "s_suppkey"
    rows = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    geo = f"""concat('{{"lat": ', {k} % 90, '.5, "lon": -', {k} % 180, '.25}}')"""
    values = {
        "supplier_id": _key(k),
        "supplier_code": "s_name",
        "tenant_id": "concat('tenant_', n_regionkey)",
        "legal_name": f"CASE WHEN {k} % 17 <> 5 THEN s_name END",
        "dba_name": f"CASE WHEN {k} % 3 = 0 THEN concat(s_name, ' Trading') END",
        "country": f"CASE WHEN {k} % 23 = 7 THEN '{C.BOGUS_COUNTRY}' "
        f"ELSE {_one_of(C.COUNTRIES, 'n_nationkey % 9')} END",
        "region": "NULL",
        "address_line1": f"concat('  ', {k} % 500, '  mill\\tLane ')",
        "address_line2": f"CASE WHEN {k} % 5 = 0 THEN concat('unit ', {k} % 100) WHEN {k} % 5 = 1 THEN '  ' END",
        "city": "lower(n_name)",
        "state": "NULL",
        "postal_code": f"lpad({k} % 100000, 5, '0')",
        "contact_email": f"CASE WHEN {k} % 13 <> 0 THEN concat('contact', {k}, '@example.com') END",
        "contact_phone": f"concat('+1-555-', lpad({k} % 10000000, 7, '0'))",
        "preferred_currency": "NULL",
        "incoterms": _one_of(C.INCOTERMS, f"{k} % 4"),
        "lead_time_days_avg": f"int(CASE WHEN {k} % 37 = 1 THEN -1 ELSE {k} % 60 + 3 END)",
        "lead_time_days_p95": f"int({k} % 80 + 7)",
        "on_time_delivery_rate": f"double(CASE WHEN {k} % 19 = 3 THEN 104 ELSE {k} * 7 % 41 + 60 END)",
        "defect_rate_ppm": f"int({k} * 37 % 900)",
        "capacity_units_per_week": f"int({k} * 53 % 9000 + 100)",
        "risk_score": "s_acctbal / 100",
        "financial_risk_tier": "NULL",
        "certifications": _one_of(
            ("ISO9001", "ISO9001,AS9100", "IATF16949,ISO14001", "ISO9001,ISO9999"),
            f"CASE WHEN {k} % 27 = 4 THEN 3 ELSE {k} % 3 END",
        ),
        "compliance_flags": _one_of(("", "REACH", "ITAR,ROHS"), f"{k} % 3"),
        "approved_status": f"CASE WHEN {k} % 41 = 2 THEN 'UNKNOWN' WHEN {k} % 10 = 9 THEN 'PENDING' "
        "ELSE 'APPROVED' END",
        "contracts": f"CASE WHEN {k} % 2 = 0 THEN '' ELSE concat('CONTRACT_', lpad({k}, 8, '0')) END",
        "terms_version": f"concat({k} % 5 + 1, '.', {k} % 10)",
        "geo_coords": f"""CASE WHEN {k} % 11 = 6 THEN NULL WHEN {k} % 9 = 2 THEN '{{"lat": null, "lon": null}}'
            WHEN {k} % 9 = 5 THEN '' ELSE {geo} END""",
        "data_source": f"CASE WHEN {k} % 11 = 6 THEN {geo} ELSE '{C.DATA_SOURCE}' END",
        "source_timestamp": f"concat('2024-01-', lpad({k} % 28 + 1, 2, '0'), 'T00:00:00.000000Z')",
        "ingestion_timestamp": f"'{MOMENT}'",
        "schema_version": f"'{C.SCHEMA_VERSION}'",
    }
    country = F.col("country")
    return _projection(rows, values).withColumns(
        {
            "region": derive_region(country),
            "state": F.when(country == "US", "CA"),
            "preferred_currency": derive_currency(country),
            "financial_risk_tier": risk_tier(F.col("risk_score"), negative_is_low=True),
        }
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """All 23 columns, referring to the suppliers of the part's line items, shifted by the part key."""
    k = "p_partkey"
    total = table(spark, folder, "supplier").agg(F.count("*")).scalar()
    used = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(F.min("l_suppkey").alias("_first"), F.max("l_suppkey").alias("_last"))
    )
    rows = table(spark, folder, "part").join(used, F.col(k) == F.col("l_partkey"), "left")
    rows = rows.withColumns({"_lo": (F.col("_first") + F.col(k)) % total, "_hi": (F.col("_last") + F.col(k)) % total})
    low, high = _key("_lo"), _key("_hi")
    values = {
        "part_id": f"concat('P', lpad({k}, 8, '0'))",
        "tenant_id": f"concat('tenant_', {k} % 5)",
        "part_number": "p_name",
        "description": f"concat('Part ', {k}, ' ', p_type)",
        "category": f"""CASE WHEN {k} % 43 = 6 THEN 'BOGUS' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'ELECTRICAL'
            WHEN p_type IN ('STANDARD', 'LARGE') THEN 'MECHANICAL' WHEN p_type = 'ECONOMY' THEN 'RAW_MATERIAL'
            ELSE 'OTHER' END""",
        "lifecycle_status": f"CASE WHEN {k} % 20 = 0 THEN 'EOL' WHEN {k} % 10 = 3 THEN 'NEW' ELSE 'ACTIVE' END",
        "uom": f"CASE WHEN {k} % 53 = 9 THEN 'INVALID_UOM' ELSE {_one_of(C.UNITS, f'{k} % 3')} END",
        "spec_hash": f"concat('SPEC_', lpad({k}, 16, '0'))",
        "bom_compatibility": f"CASE WHEN {k} % 2 = 0 THEN '' ELSE concat('BOM_', lpad({k} % 1000, 8, '0')) END",
        "default_supplier_id": f"CASE WHEN {k} % 47 = 8 THEN '' ELSE {low} END",
        "qualified_supplier_ids": f"""CASE WHEN {k} % 29 = 11 THEN concat({low}, ',S99999999')
            WHEN _lo = _hi THEN {low} ELSE concat({low}, ',', {high}) END""",
        "unit_cost": f"CAST(CASE WHEN {k} % 31 = 4 THEN -p_retailprice ELSE p_retailprice END AS decimal(18,6))",
        "moq": "p_size",
        "lead_time_days_avg": "p_size % 40",
        "lead_time_days_p95": "p_size % 40 + 8",
        "quality_grade": _one_of(C.QUALITY_GRADES, f"{k} % 3"),
        "compliance_flags": _one_of(("", "ROHS", "REACH,ITAR"), f"{k} % 3"),
        "hazard_class": f"CASE WHEN {k} % 10 = 0 THEN {_one_of(C.HAZARD_CLASSES, f'{k} % 4')} END",
        "last_price_change": f"concat('2023-', lpad({k} % 12 + 1, 2, '0'), '-', lpad({k} % 28 + 1, 2, '0'))",
        "data_source": f"'{C.DATA_SOURCE}'",
        "source_timestamp": f"concat('2024-01-', lpad({k} % 28 + 1, 2, '0'), 'T00:00:00.000000Z')",
        "ingestion_timestamp": f"'{MOMENT}'",
        "schema_version": f"'{C.SCHEMA_VERSION}'",
    }
    return _projection(rows, values)


def _landed(frame: DataFrame, key: str, changes: dict[str, str]) -> DataFrame:
    """Put text-typed and faulty values in place and add the connector's columns. ``k`` is the numeric key."""
    numbered = frame.selectExpr("*", f"bigint(substr({key}, 2)) AS k")
    connector = [f"concat('{name}:', {key}) AS {name}" for name in C.CONNECTOR_COLUMNS]
    kept = [f"{changes[name]} AS {name}" if name in changes else name for name in frame.columns]
    return numbered.selectExpr(*kept, *connector)


def landed_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """The same suppliers as the connector lands them: extra columns, codes and tenants exchanged, text numbers."""
    faulty = "CASE WHEN k % 13 = 1 THEN 'abc' WHEN k % 13 = 2 THEN ''"
    changes = {
        "tenant_id": "concat('S', k % 900000 + 100000)",
        "supplier_code": "tenant_id",
        "on_time_delivery_rate": f"{faulty} ELSE concat(k * 7 % 41 + 60, '.5') END",
        "risk_score": f"{faulty} ELSE concat(' ', k % 101, ' ') END",
        "defect_rate_ppm": """CASE WHEN k % 7 = 3 THEN concat(k % 900, '.9') WHEN k % 29 = 5 THEN '99999999999'
            WHEN k % 31 = 6 THEN '1e3' ELSE string(k % 900) END""",
        "capacity_units_per_week": f"{faulty} ELSE concat('+', k % 9000) END",
        "lead_time_days_avg": "CASE WHEN k % 17 = 2 THEN '-3.9' ELSE string(k % 60) END",
        "lead_time_days_p95": "string(k % 80)",
    }
    return _landed(suppliers(spark, folder), "supplier_id", changes)


def landed_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as landed: extra columns, text numbers, and list texts in four notations."""
    one, two = _key("k % 100"), _key("k % 70")
    changes = {
        "qualified_supplier_ids": f"""CASE WHEN k % 37 = 5 THEN '[]' WHEN k % 37 = 6 THEN ''
            WHEN k % 4 = 0 THEN concat({one}, ',', {two})
            WHEN k % 4 = 1 THEN concat('["', {one}, '", "', {two}, '"]')
            WHEN k % 4 = 2 THEN concat("['", {one}, "','", {two}, "']")
            ELSE concat('\\t', {one}, ' , ,', {two}, ',') END""",
        "unit_cost": "CASE WHEN k % 13 = 1 THEN 'n/a' ELSE concat(k % 5000, '.', lpad(k % 1000, 3, '0')) END",
        "moq": "CASE WHEN k % 11 = 2 THEN '' ELSE string(k % 500) END",
        "lead_time_days_avg": "concat(k % 40, '.7')",
        "lead_time_days_p95": "string(k % 50)",
    }
    return _landed(parts(spark, folder), "part_id", changes)


def accounts(frame: DataFrame, key: str, name: str, balance: str) -> DataFrame:
    """A plain keyed table, used as base and batch of merges."""
    return frame.selectExpr(f"{key} AS account", f"{name} AS name", f"double({balance}) AS balance")
