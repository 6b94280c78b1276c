"""Repair of landed rows: connector columns, swapped columns, text numbers, misplaced geo coordinates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.lists import is_array, strip_space, text_to_list

# Numeric columns that arrive as text, with the types the job needs.
NUMERIC = {
    C.SUPPLIERS: {
        "risk_score": "double",
        "on_time_delivery_rate": "double",
        "defect_rate_ppm": "int",
        "capacity_units_per_week": "int",
        "lead_time_days_avg": "int",
        "lead_time_days_p95": "int",
    },
    C.PARTS: {
        "unit_cost": "decimal(18,6)",
        "moq": "int",
        "lead_time_days_avg": "int",
        "lead_time_days_p95": "int",
    },
}
# Where a known ingestion fault exchanges two columns, and the prefix that gives it away.
SWAP_PARTNER = {C.SUPPLIERS: "supplier_code", C.PARTS: "part_number"}
SWAP_PREFIX = {C.SUPPLIERS: "S", C.PARTS: "P-"}
SWAP_PATTERN = {C.SUPPLIERS: r"^S\d{6}$", C.PARTS: r"^P-\d{6}$"}
# Coordinates inside a JSON text.
LAT_PATTERN = r'"lat":\s*([-\d.]+)'
LON_PATTERN = r'"lon":\s*([-\d.]+)'

_PLAIN_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"
_ANY_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,4})?\s*$"


def drop_connector_metadata(frame: DataFrame) -> DataFrame:
    return frame.drop(*C.CONNECTOR_COLUMNS)


#: Columns that tell apart what was ingested together, and so shares the fault or is sound.
RUN_COLUMNS = ("landing_tenant", "landing_run_id", "source_file")


def swap_share(frame: DataFrame, pattern: str, column: str = "tenant_id", by: tuple[str, ...] = ()) -> DataFrame:
    """The share of non-empty values that look like the partner column's codes (0 without rows): one row, or one by run."""
    value = F.col(column)
    filled = F.count_if(value.isNotNull() & (value != ""))
    share = F.coalesce(F.try_divide(F.count_if(value.rlike(pattern)), filled), F.lit(0.0)).alias("share")
    return frame.groupBy(*by).agg(share) if by else frame.agg(share)


def repair_swap(
    frame: DataFrame, entity: str, pattern: str | None = None, min_share: float = 0.5, column: str = "tenant_id"
) -> DataFrame:
    """Exchange ``tenant_id`` with its partner column in the runs whose rows mostly give the fault away.

    All rows of a run vote, so the outcome does not depend on row order or on what else is read, and a tenant whose name
    merely starts with the prefix is left alone. Runs are told by the ``RUN_COLUMNS`` that the frame has; without any the
    whole frame is one run, and its vote a scalar subquery. ``pattern="^S"`` with ``min_share=0.0`` swaps as soon as any
    row carries the prefix.
    """
    partner, pattern = SWAP_PARTNER[entity], pattern or SWAP_PATTERN[entity]
    runs = tuple(name for name in RUN_COLUMNS if name in frame.columns)
    if runs:
        votes = swap_share(frame, pattern, column, runs).where(F.col("share") > min_share)
        votes = F.broadcast(votes.select(*[F.col(run).alias(f"_{run}") for run in runs], F.lit(True).alias("_swapped")))
        same = reduce(lambda a, b: a & b, [F.col(run).eqNullSafe(F.col(f"_{run}")) for run in runs])
        joined, swapped = frame.join(votes, same, "left"), F.col("_swapped")  # a vote is a row for each run
    else:
        joined, swapped = frame, swap_share(frame, pattern, column).scalar() > F.lit(min_share)
    return joined.select(
        *[
            F.when(swapped, F.col(partner)).otherwise(F.col(name)).alias(name)
            if name == column
            else F.when(swapped, F.col(column)).otherwise(F.col(name)).alias(name)
            if name == partner
            else F.col(name)
            for name in frame.columns
        ]
    )


def whole_number(value: Column, is_text: bool, exponents: bool = False) -> Column:
    """As int; fractions are cut off, text that is no plain number and values out of range become NULL.

    With ``exponents`` text such as ``1.2E7`` is a number too.
    """
    if not is_text:
        return value.try_cast("int")
    pattern = _ANY_NUMBER if exponents else _PLAIN_NUMBER
    return F.when(value.rlike(pattern), value.try_cast("decimal(38,6)").try_cast("int"))


def cast_contract(frame: DataFrame, entity: str, exponents: bool = False) -> DataFrame:
    """Numeric columns to the job's types where present; unreadable values become NULL.

    Whole numbers written with an exponent are unreadable unless ``exponents`` is set, as some writers need it.
    """
    kinds = dict(frame.dtypes)
    casts = {}
    for name, kind in NUMERIC[entity].items():
        if name not in kinds or kinds[name] == kind:
            continue
        if kind == "int":
            casts[name] = whole_number(F.col(name), kinds[name] == "string", exponents)
        else:
            casts[name] = F.col(name).try_cast(kind)
    return frame.withColumns(casts) if casts else frame


def _point(lat: Column, lon: Column) -> Column:
    return F.struct(lat.try_cast("double").alias("lat"), lon.try_cast("double").alias("lon"))


def repair_geo(frame: DataFrame) -> DataFrame:
    """``geo_coords`` as struct<lat,lon>, from ``data_source`` when the coordinates landed there.

    The struct itself is never NULL; unusable text gives a struct of two NULLs. A column that already is a
    struct is kept, and split ``geo_lat``/``geo_lon`` columns are joined.
    """
    kinds = dict(frame.dtypes)
    if "geo_lat" in kinds and "geo_lon" in kinds and "geo_coords" not in kinds:
        joined = frame.withColumn("geo_coords", _point(F.col("geo_lat"), F.col("geo_lon")))
        return joined.drop("geo_lat", "geo_lon")
    if kinds["geo_coords"].startswith("struct"):
        return frame
    source, geo = F.col("data_source"), F.col("geo_coords")
    misplaced = source.contains("lat") & source.contains("lon")
    usable = geo.isNotNull() & (geo != "") & ~geo.contains("null")
    missing = F.lit(None).cast("double")
    repaired = (
        F.when(misplaced, _point(F.regexp_extract(source, LAT_PATTERN, 1), F.regexp_extract(source, LON_PATTERN, 1)))
        .when(usable, _point(F.get_json_object(geo, "$.lat"), F.get_json_object(geo, "$.lon")))
        .otherwise(_point(missing, missing))
    )
    return frame.withColumn("geo_coords", repaired)


def apply_defaults(frame: DataFrame) -> DataFrame:
    """Defaults of the customer database for absent columns; a present NULL stays NULL."""
    absent = {}
    if "ingestion_timestamp" not in frame.columns:
        absent["ingestion_timestamp"] = F.current_timestamp()
    if "schema_version" not in frame.columns:
        absent["schema_version"] = F.lit(C.SCHEMA_VERSION)
    return frame.withColumns(absent) if absent else frame


def clean(frame: DataFrame, entity: str) -> DataFrame:
    """All repairs a landed table needs before its rows are tagged."""
    return cast_contract(repair_swap(drop_connector_metadata(frame), entity), entity)


def normalise_address(frame: DataFrame, names: tuple[str, ...] = ("address_line1", "address_line2", "city")) -> DataFrame:
    """Upper case, edges trimmed, runs of white space as one blank, empty text as NULL."""

    def tidy(value: Column) -> Column:
        return F.nullif(F.upper(F.regexp_replace(strip_space(value), r"\s+", " ")), F.lit(""))

    return frame.withColumns({name: tidy(F.col(name)) for name in names if name in frame.columns})


def typed_view(frame: DataFrame, entity: str) -> DataFrame:
    """The contract's own types: lists as arrays, rates as decimals, dates and timestamps parsed."""
    out = []
    kinds = dict(frame.dtypes)
    for name, kind in C.CONTRACT[entity].items():
        value = F.col(name)
        if kind == "array<string>":
            value = value if is_array(frame, name) else text_to_list(value)
        elif kind == "date" and kinds[name] == "string":
            value = F.to_date(F.try_to_timestamp(value))
        elif kind == "timestamp" and kinds[name] == "string":
            value = F.try_to_timestamp(value)
        elif kind == "int":
            value = whole_number(value, kinds[name] == "string")
        elif kind.startswith("decimal"):
            value = value.try_cast(kind)
        out.append(value.alias(name))
    return frame.select(*out)
