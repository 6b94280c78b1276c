"""Readers for the landing zone and for exported files."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearlot import contracts as C
from clearlot.sources.schemas import as_type, schemas_by_file, widest

# Conditions that mean that a source is not there.
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
# Folder layouts .../processed/{tenant}/{entity}/{date}/{run}/... and .../{tenant}/{date}/{run}/...
PROCESSED_LAYOUT = r"/processed/([^/]+)/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d{8}_\d{6})/"
UPLOAD_LAYOUT = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d{8}_\d{6})/([^/.]+)[^/]*"


def landing_glob(root: str, tenant: str, entity: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/processed/{tenant}/{entity}/{run_date}/*/{entity}*.parquet*"


def run_folder(root: str, tenant: str, entity: str, run_date: str, run_id: str) -> str:
    """Where one run of an entity lands."""
    return f"{root.rstrip('/')}/processed/{tenant}/{entity}/{run_date}/{run_id}/{entity}.parquet"


def read_landing(
    spark: SparkSession, root: str, tenant: str, entity: str, run_date: str, merge_schema: bool = False
) -> DataFrame:
    """All runs of one date together, so rows that landed twice appear twice.

    ``tenant="*"`` reads every tenant in one job. Column types are those of the files; ``merge_schema`` also
    picks up columns that only some runs have.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(landing_glob(root, tenant, entity, run_date))


def landed_schemas(
    spark: SparkSession, root: str, tenant: str, entity: str, run_date: str
) -> dict[str, T.StructType]:
    """Columns and types of every landed file of a date, by its path: one job reads all footers.

    ``read_runs`` and ``run_drift`` take the result, so that a job that wants both looks into the files once.
    """
    return schemas_by_file(spark, landing_glob(root, tenant, entity, run_date))


def landed_tenants(spark: SparkSession, root: str, entity: str, run_date: str) -> list[str]:
    """The tenants that landed an entity on a date; only the files are listed."""
    files = spark.read.format("binaryFile").load(landing_glob(root, "*", entity, run_date))
    named = files.select(F.regexp_extract("path", PROCESSED_LAYOUT, 1).alias("tenant")).distinct()
    return sorted(row.tenant for row in named.collect())


def read_runs(
    spark: SparkSession,
    root: str,
    tenant: str,
    entity: str,
    run_date: str,
    schemas: dict[str, T.StructType] | None = None,
) -> DataFrame:
    """All runs of one date with their lineage, whatever columns and types each run has.

    Files are read by their own schemas, those of one schema together. A column that only some have is NULL in the others.
    Where the types of a column differ it gets the narrowest type that holds all values (``schemas.widest``), which is text in
    the end: numbers without exponents, lists as comma text, structs as JSON, as the job's repairs expect. A date without
    runs is an error, as for any reader.
    """
    schemas = landed_schemas(spark, root, tenant, entity, run_date) if schemas is None else schemas
    base = f"{root.rstrip('/')}/processed"
    alike: dict[tuple, list[str]] = {}
    kinds: dict[str, dict[str, T.DataType]] = {}
    for path, schema in schemas.items():
        alike.setdefault(tuple((field.name, field.dataType.simpleString()) for field in schema), []).append(path)
        for field in schema:
            kinds.setdefault(field.name, {})[field.dataType.simpleString()] = field.dataType
    target = {name: widest(found.values()) for name, found in kinds.items() if len(found) > 1}
    frames = []
    for files in alike.values():
        schema = schemas[files[0]]
        frame = with_lineage(spark.read.schema(schema).option("basePath", base).parquet(*files))
        changed = {
            field.name: as_type(F.col(f"`{field.name}`"), field.dataType, target[field.name])
            for field in schema
            if field.name in target
        }
        frames.append(frame.withColumns(changed) if changed else frame)
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def run_drift(
    spark: SparkSession,
    root: str,
    tenant: str,
    entity: str,
    run_date: str,
    schemas: dict[str, T.StructType] | None = None,
) -> DataFrame:
    """A row for each run and column that some runs lack or hold in another type: its type there, or ``missing``.

    Where the files of one run differ, all their types are named.
    """
    schemas = landed_schemas(spark, root, tenant, entity, run_date) if schemas is None else schemas
    runs: dict[tuple[str, str], dict[str, set[str]]] = {}
    for path, schema in schemas.items():
        tenant_name, _, _, run_id = re.search(PROCESSED_LAYOUT, path).groups()
        found = runs.setdefault((run_id, tenant_name), {})
        for field in schema:
            found.setdefault(field.name, set()).add(field.dataType.simpleString())
    told = {run: {name: " or ".join(sorted(kinds)) for name, kinds in found.items()} for run, found in runs.items()}
    names = sorted({name for kinds in told.values() for name in kinds})
    drifting = [name for name in names if len({kinds.get(name, "missing") for kinds in told.values()}) > 1]
    rows = [(run[0], name, kinds.get(name, "missing")) for run, kinds in sorted(told.items()) for name in drifting]
    return spark.createDataFrame(rows, "landing_run_id string, field string, type string")


def _source_path() -> Column:
    """The path of a row's file as it was written; Spark reports it with percent signs for special characters."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def with_lineage(frame: DataFrame) -> DataFrame:
    """Add tenant, entity, date and run id from the path; call it on a frame fresh from a file reader."""
    path = _source_path()
    names = ("landing_tenant", "landing_entity", "landing_date", "landing_run_id")
    return frame.select(
        "*",
        *[F.regexp_extract(path, PROCESSED_LAYOUT, at).alias(name) for at, name in enumerate(names, start=1)],
    )


def with_upload_lineage(frame: DataFrame) -> DataFrame:
    """The same for the upload layout, where the file name stands for the entity."""
    path = _source_path()
    names = ("landing_tenant", "landing_date", "landing_run_id", "landing_entity")
    return frame.select(
        "*", *[F.regexp_extract(path, UPLOAD_LAYOUT, at).alias(name) for at, name in enumerate(names, start=1)]
    )


def read_or_none(read, required: bool = False) -> DataFrame | None:
    """Run a reader; a missing source gives None, or the error when the source is required."""
    try:
        return read()
    except AnalysisException as error:
        if required or error.getCondition() not in MISSING:
            raise
        return None


def read_csv(
    spark: SparkSession, path: str, entity: str, header: list[str] | None = None, line_breaks: bool = True
) -> DataFrame:
    """A header CSV with the contract's columns, all as text.

    Columns are told by the header, in whatever order the file has them; columns that it lacks are empty, others than
    ``header`` (the contract's, unless given) are left out. The files of a folder share one header; a file with another
    one is refused. Fields may hold line breaks, so a file is read by one task: ``write_csv_chunked`` keeps files short. Without
    ``line_breaks`` no field may hold one, and a long file is split among tasks.
    Every field is taken as written: the writer has no mark for NULL, so missing values and empty lists both come back as
    the empty string.
    """
    names = header or C.columns(entity)
    reader = spark.read.options(header=True, encoding="UTF-8", escape='"', multiLine=line_breaks, enforceSchema=False)
    found = reader.csv(min(spark.read.text(path).inputFiles())).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in found])
    frame = reader.schema(schema).csv(path).na.fill("")
    return frame.select(*[F.col(f"`{name}`") if name in found else F.lit("").alias(name) for name in names])
