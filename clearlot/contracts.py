"""Data contracts of the two entities, as plain type names that Spark understands.

Four shapes of the same columns are in use: the *landing* file (text-typed numbers, comma text lists, JSON
geo), the *curated* table (numbers typed, lists still text, geo a struct), the *contract* (lists as arrays,
decimals, dates) and the *SQL* table of the customer database (lengths, defaults, keys).
"""

from __future__ import annotations

from pyspark.sql import types as T

SUPPLIERS = "suppliers"
PARTS = "parts"
ENTITIES = (SUPPLIERS, PARTS)

# Contract columns in file order with their contract types.
CONTRACT = {
    SUPPLIERS: {
        "supplier_id": "string",
        "supplier_code": "string",
        "tenant_id": "string",
        "legal_name": "string",
        "dba_name": "string",
        "country": "string",
        "region": "string",
        "address_line1": "string",
        "address_line2": "string",
        "city": "string",
        "state": "string",
        "postal_code": "string",
        "contact_email": "string",
        "contact_phone": "string",
        "preferred_currency": "string",
        "incoterms": "string",
        "lead_time_days_avg": "int",
        "lead_time_days_p95": "int",
        "on_time_delivery_rate": "decimal(5,2)",
        "defect_rate_ppm": "int",
        "capacity_units_per_week": "int",
        "risk_score": "decimal(5,2)",
        "financial_risk_tier": "string",
        "certifications": "array<string>",
        "compliance_flags": "array<string>",
        "approved_status": "string",
        "contracts": "array<string>",
        "terms_version": "string",
        "geo_coords": "struct<lat:double,lon:double>",
        "data_source": "string",
        "source_timestamp": "timestamp",
        "ingestion_timestamp": "timestamp",
        "schema_version": "string",
    },
    PARTS: {
        "part_id": "string",
        "tenant_id": "string",
        "part_number": "string",
        "description": "string",
        "category": "string",
        "lifecycle_status": "string",
        "uom": "string",
        "spec_hash": "string",
        "bom_compatibility": "array<string>",
        "default_supplier_id": "string",
        "qualified_supplier_ids": "array<string>",
        "unit_cost": "decimal(18,6)",
        "moq": "int",
        "lead_time_days_avg": "int",
        "lead_time_days_p95": "int",
        "quality_grade": "string",
        "compliance_flags": "array<string>",
        "hazard_class": "string",
        "last_price_change": "date",
        "data_source": "string",
        "source_timestamp": "timestamp",
        "ingestion_timestamp": "timestamp",
        "schema_version": "string",
    },
}

PRIMARY_KEY = {SUPPLIERS: "supplier_id", PARTS: "part_id"}
BUSINESS_CODE = {SUPPLIERS: "supplier_code", PARTS: "part_number"}
REQUIRED = {
    SUPPLIERS: ("supplier_id", "tenant_id", "legal_name"),
    PARTS: ("part_id", "tenant_id", "part_number"),
}

# Closed domains.
FINANCIAL_TIERS = ("LOW", "MEDIUM", "HIGH")
APPROVED_STATUSES = ("PENDING", "APPROVED", "SUSPENDED", "BLACKLISTED")
PART_CATEGORIES = ("ELECTRICAL", "MECHANICAL", "RAW_MATERIAL", "OTHER")
LIFECYCLE_STATUSES = ("NEW", "ACTIVE", "NRND", "EOL")
CERTIFICATIONS = ("ISO9001", "IATF16949", "AS9100", "ISO14001")
COMPLIANCE_FLAGS = ("ITAR", "REACH", "ROHS")
UNITS = ("EA", "KG", "M")
QUALITY_GRADES = ("A", "B", "C")
HAZARD_CLASSES = ("CLASS_1", "CLASS_3", "CLASS_8", "CLASS_9")
INCOTERMS = ("DDP", "FOB", "CIF", "EXW")

DOMAINS = {
    SUPPLIERS: {"financial_risk_tier": FINANCIAL_TIERS, "approved_status": APPROVED_STATUSES},
    PARTS: {
        "category": PART_CATEGORIES,
        "lifecycle_status": LIFECYCLE_STATUSES,
        "uom": UNITS,
        "quality_grade": QUALITY_GRADES,
    },
}
RANGES = {
    SUPPLIERS: {
        "lead_time_days_avg": (0, None),
        "lead_time_days_p95": (0, None),
        "on_time_delivery_rate": (0, 100),
        "defect_rate_ppm": (0, None),
        "capacity_units_per_week": (0, None),
        "risk_score": (0, 100),
    },
    PARTS: {
        "unit_cost": (0, None),
        "moq": (0, None),
        "lead_time_days_avg": (0, None),
        "lead_time_days_p95": (0, None),
    },
}

# What the curated tables hold where they differ from the contract.
CURATED_OVERRIDES = {
    SUPPLIERS: {
        "on_time_delivery_rate": "double",
        "risk_score": "double",
        "certifications": "string",
        "compliance_flags": "string",
        "contracts": "string",
    },
    PARTS: {
        "bom_compatibility": "string",
        "qualified_supplier_ids": "string",
        "compliance_flags": "string",
        "last_price_change": "string",
    },
}
QUALITY_COLUMNS = {"dq_violations": "array<string>", "is_valid": "boolean", "dq_timestamp": "timestamp"}
CURATED_TABLE = {SUPPLIERS: "dim_suppliers_v1", PARTS: "dim_parts_v1"}
# Columns that curated tables add: the run a row came from, a key of the tenant that is never empty, the landing date.
LINEAGE_COLUMNS = {"landing_run_id": "string", "tenant_key": "string", "landing_date": "string"}
CURATED_PARTITIONS = {
    SUPPLIERS: ("tenant_key", "landing_date"),
    PARTS: ("tenant_key", "landing_date", "category"),
}
UNDATED = "undated"
CURATED_BUCKETS = 16
# Country codes of the synthetic suppliers, and the one that stands for none.
COUNTRIES = ("CN", "US", "DE", "MX", "IN", "VN", "PL", "JP", "KR")
BOGUS_COUNTRY = "XX"
# Fixed value: rows per exchange file, and per curated file where a cap is wanted.
ROWS_PER_FILE = 50_000

# Columns the ingestion connector adds to landing files.
CONNECTOR_COLUMNS = (
    "_airbyte_raw_id",
    "_airbyte_extracted_at",
    "_airbyte_meta",
    "_airbyte_generation_id",
    "_ab_source_file_url",
    "_ab_source_file_last_modified",
)

# The customer database.
SQL_LENGTHS = {
    SUPPLIERS: {
        "supplier_id": 26, "tenant_id": 50, "supplier_code": 50, "legal_name": 255, "dba_name": 255,
        "country": 2, "region": 50, "address_line1": 255, "address_line2": 255, "city": 100, "state": 50,
        "postal_code": 20, "contact_email": 255, "contact_phone": 50, "preferred_currency": 3,
        "incoterms": 10, "financial_risk_tier": 10, "approved_status": 20, "terms_version": 20,
        "data_source": 100, "schema_version": 10,
    },
    PARTS: {
        "part_id": 26, "tenant_id": 50, "part_number": 100, "category": 50, "lifecycle_status": 20,
        "uom": 10, "spec_hash": 64, "default_supplier_id": 26, "quality_grade": 1, "hazard_class": 50,
        "data_source": 100, "schema_version": 10,
    },
}
SQL_DECIMALS = {
    SUPPLIERS: {"on_time_delivery_rate": (5, 2), "risk_score": (5, 2)},
    PARTS: {"unit_cost": (18, 6)},
}
SQL_UPDATE_COLUMNS = {
    SUPPLIERS: (
        "legal_name", "risk_score", "on_time_delivery_rate", "defect_rate_ppm", "approved_status",
        "source_timestamp", "ingestion_timestamp",
    ),
    PARTS: (
        "unit_cost", "moq", "lead_time_days_avg", "lead_time_days_p95", "lifecycle_status",
        "default_supplier_id", "qualified_supplier_ids", "source_timestamp", "ingestion_timestamp",
    ),
}
SCHEMA_VERSION = "1.0.0"
DATA_SOURCE = "synthetic.v1"

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(18,6)": T.DecimalType(18, 6),
    "struct<lat:double,lon:double>": T.StructType(
        [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
    ),
}


def columns(entity: str) -> list[str]:
    return list(CONTRACT[entity])


def list_columns(entity: str) -> list[str]:
    return [name for name, kind in CONTRACT[entity].items() if kind.startswith("array")]


def sql_columns(entity: str) -> list[str]:
    """Column order of the customer database, which puts ``tenant_id`` second in both tables."""
    rest = [name for name in CONTRACT[entity] if name not in (PRIMARY_KEY[entity], "tenant_id")]
    return [PRIMARY_KEY[entity], "tenant_id", *rest]


def curated_types(entity: str) -> dict[str, str]:
    return {**CONTRACT[entity], **CURATED_OVERRIDES[entity]}


def contract_schema(entity: str) -> T.StructType:
    """The contract as a ``StructType`` whose field metadata carries the rules."""
    fields = []
    for name, kind in CONTRACT[entity].items():
        low, high = RANGES[entity].get(name, (None, None))
        metadata = {"required": name in REQUIRED[entity]}
        if name in DOMAINS[entity]:
            metadata["enum"] = list(DOMAINS[entity][name])
        if low is not None:
            metadata["min"] = low
        if high is not None:
            metadata["max"] = high
        fields.append(T.StructField(name, _SPARK_TYPES[kind], True, metadata))
    return T.StructType(fields)


def curated_schema(entity: str) -> T.StructType:
    kinds = {**curated_types(entity), **QUALITY_COLUMNS}
    return T.StructType([T.StructField(name, _SPARK_TYPES[kind]) for name, kind in kinds.items()])
