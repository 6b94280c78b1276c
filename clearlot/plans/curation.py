"""The curation job: landed files in, curated and quarantined tables and a report out."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.operators import metrics as M
from clearlot.operators.clean import clean
from clearlot.operators.curate import curated_projection, quarantined_rows
from clearlot.operators.members import DEFAULT_LIMITS, Limits, Measure
from clearlot.operators.references import tag_parts
from clearlot.operators.rules import tag_suppliers, valid_ids, valid_rows
from clearlot.session import staged
from clearlot.sources.landing import landed_tenants, read_or_none, read_runs
from clearlot.sources.tables import (
    append_rows,
    buckets_for,
    create_curated_table,
    has_struct_column,
    stored_bytes,
    table_name,
    with_partitions,
    write_rejects,
)


@dataclass(frozen=True)
class Tagged:
    """Tagged suppliers and parts, each evaluated once and kept in the shared folder.

    ``counts`` has the rows and valid rows of each entity, as they were counted while the rows were written.
    """

    suppliers: DataFrame
    parts: DataFrame | None
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)


def tag_both(
    suppliers: DataFrame, parts: DataFrame | None, limits: Limits = DEFAULT_LIMITS, stage: bool = True
) -> Tagged:
    """Tag suppliers, then parts against the valid ones.

    With ``stage`` each tagged table is written once, split by validity: ids, curated rows and quarantine are then read
    from it instead of being worked out again, and carry the same timestamps. Rows are counted on the way.
    """
    counts: dict[str, tuple[int, int]] = {}
    sizes: dict[str, Measure] = {}

    def kept(frame: DataFrame, entity: str) -> DataFrame:
        if not stage:
            return frame
        seen = Observation()
        key_bytes = F.when(F.col("is_valid"), F.octet_length(C.PRIMARY_KEY[entity]))
        observed = frame.observe(
            seen,
            F.count("*").alias("total"),
            F.count_if("is_valid").alias("valid"),
            F.coalesce(F.sum(key_bytes), F.lit(0)).alias("key_bytes"),
        )
        written = staged(observed, f"tagged-{entity}", ("is_valid",))
        found = seen.get
        counts[entity] = (int(found["total"]), int(found["valid"]))
        sizes[entity] = Measure(int(found["valid"]), int(found["key_bytes"]))
        return written

    tagged = kept(tag_suppliers(suppliers), C.SUPPLIERS)
    if parts is None:
        return Tagged(tagged, None, counts)
    checked = tag_parts(parts, valid_ids(tagged), limits=limits, size=sizes.get(C.SUPPLIERS), stage=stage)
    tagged_parts = kept(checked, C.PARTS)
    return Tagged(tagged, tagged_parts, counts)


def _figures(tagged: Tagged, entity: str, frame: DataFrame) -> DataFrame:
    """Rows, valid rows and pass rate: those counted while writing, or else counted now."""
    if entity not in tagged.counts:
        return M.validation_metrics(frame)
    return M.with_pass_rate(frame.sparkSession.createDataFrame([tagged.counts[entity]], "total long, valid long"))


def report(tagged: Tagged, threshold: float = 99.0) -> DataFrame:
    """Rows, valid rows, pass rate and gate per entity and overall; of staged tables nothing is read for it."""
    rows = [_figures(tagged, C.SUPPLIERS, tagged.suppliers).withColumn("entity", F.lit(C.SUPPLIERS))]
    if tagged.parts is not None:
        rows.append(_figures(tagged, C.PARTS, tagged.parts).withColumn("entity", F.lit(C.PARTS)))
    rows.append(M.overall_pass_rate(*rows).withColumn("entity", F.lit("overall")))
    stacked = rows[0]
    for row in rows[1:]:
        stacked = stacked.unionByName(row)
    return M.quality_gate(stacked, threshold).select("entity", "total", "valid", "pass_rate", "passed")


def tenant_report(tagged: Tagged, threshold: float = 99.0) -> DataFrame:
    """The same figures and gate for each landing tenant and entity."""
    both = [(C.SUPPLIERS, tagged.suppliers), (C.PARTS, tagged.parts)]
    rows = [
        M.validation_metrics(frame, ["landing_tenant"]).withColumn("entity", F.lit(entity))
        for entity, frame in both
        if frame is not None
    ]
    stacked = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    return M.quality_gate(stacked, threshold).select("landing_tenant", "entity", "total", "valid", "pass_rate", "passed")


def write_curated(
    spark: SparkSession,
    tagged: Tagged,
    database: str | None = None,
    location: str | None = None,
    quarantine: str | None = None,
    replace: bool = False,
    buckets: int | None = None,
    rows_per_file: int = 0,
    replaced_too: DataFrame | None = None,
) -> dict[str, str]:
    """Write valid rows to the curated tables and invalid ones to the quarantine folder, suppliers first.

    With ``replace`` each tenant and landing date of the rows, and of ``replaced_too``, is replaced exactly. A table that
    is not there yet gets as many buckets as the size of its first load asks for, unless ``buckets`` names a number.
    """
    names = {}
    for entity, frame in ((C.SUPPLIERS, tagged.suppliers), (C.PARTS, tagged.parts)):
        if frame is None:
            continue
        name = table_name(entity, database)
        place = f"{location}/{C.CURATED_TABLE[entity]}" if location else None
        asked = buckets_for(stored_bytes(frame)) if buckets is None else buckets
        create_curated_table(spark, entity, name, place, buckets=asked)
        # Tenants without a valid row, or without a rejected one, are replaced by nothing.
        seen = with_partitions(frame).select("tenant_key", "landing_date").distinct()
        replaced = seen if replaced_too is None else seen.unionByName(replaced_too)
        valid = curated_projection(valid_rows(frame), entity)
        append_rows(valid, entity, name, replace, rows_per_file, replaced if replace else None)
        if quarantine:
            write_rejects(quarantined_rows(frame), f"{quarantine}/{entity}", replace, replaced if replace else None)
        names[entity] = name
    return names


def run(
    spark: SparkSession,
    root: str,
    tenant: str,
    run_date: str,
    database: str | None = None,
    location: str | None = None,
    quarantine: str | None = None,
    replace: bool = False,
    threshold: float = 99.0,
    limits: Limits = DEFAULT_LIMITS,
    buckets: int | None = None,
    rows_per_file: int = 0,
    by_tenant: bool = False,
) -> DataFrame | None:
    """Curate one landing date. Without suppliers nothing is done; without parts only suppliers are curated.

    ``tenant="*"`` curates all tenants that landed something. A second run adds its rows again unless ``replace`` is set:
    then it replaces the same tenants' rows of the same date, and no others. Returns the report, with ``by_tenant`` one
    for each landing tenant, or None.
    """

    def landed(entity: str) -> DataFrame | None:
        frame = read_or_none(lambda: read_runs(spark, root, tenant, entity, run_date))
        return None if frame is None else clean(frame, entity)

    suppliers = landed(C.SUPPLIERS)
    if suppliers is None:
        return None
    tagged = tag_both(suppliers, landed(C.PARTS), limits)
    asked = None
    if replace and tenant != "*":
        asked = spark.createDataFrame([(f"t_{tenant}", run_date)], "tenant_key string, landing_date string")
    names = write_curated(
        spark, tagged, database, location, quarantine, replace, buckets, rows_per_file, replaced_too=asked
    )
    shaped = has_struct_column(spark, names[C.SUPPLIERS])
    made = tenant_report(tagged, threshold) if by_tenant else report(tagged, threshold)
    return made.withColumn("geo_is_struct", F.lit(shaped))


def run_tenants(
    spark: SparkSession,
    root: str,
    run_date: str,
    tenants: Sequence[str] | None = None,
    jobs: int = 10,
    database: str | None = None,
    location: str | None = None,
    buckets: int | None = None,
    **options,
) -> DataFrame:
    """Curate tenants as jobs of their own, up to ``jobs`` of them at a time, all into the same tables.

    Each tenant has a driver thread and a scheduling pool, so with ``spark.scheduler.mode=FAIR`` a large one does not
    hold up the others. A tenant that fails takes nothing with it: its error is reported and the others are stored. Without
    ``tenants`` all that landed something are taken. ``options`` are those of ``run``.

    Returns a row for each tenant and entity, and one with ``error`` for each tenant that failed: tenant, entity, total,
    valid, pass_rate, passed, seconds and records_per_second of the tenant's job, error.
    """
    chosen = list(tenants) if tenants is not None else landed_tenants(spark, root, C.SUPPLIERS, run_date)
    for entity in C.ENTITIES:  # before the threads ask for them at once
        if location or database:
            place = f"{location}/{C.CURATED_TABLE[entity]}" if location else None
            wanted = C.CURATED_BUCKETS if buckets is None else buckets
            create_curated_table(spark, entity, table_name(entity, database), place, buckets=wanted)

    def job(tenant: str) -> list[tuple]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", tenant)
        spark.sparkContext.setJobDescription(f"curate {tenant}")
        started = time.monotonic()
        try:
            made = run(spark, root, tenant, run_date, database, location, buckets=buckets, **options)
            rows = [] if made is None else made.where("entity <> 'overall'").collect()
        except Exception as error:  # noqa: BLE001 - whatever went wrong, it is this tenant's alone
            return [(tenant, None, None, None, None, None, time.monotonic() - started, None, str(error).splitlines()[0])]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            spark.sparkContext.setJobDescription(None)
        seconds = time.monotonic() - started
        speed = sum(row["total"] for row in rows) / seconds
        return [
            (tenant, row["entity"], row["total"], row["valid"], row["pass_rate"], row["passed"], seconds, speed, None)
            for row in rows
        ]

    with ThreadPoolExecutor(max(1, jobs)) as threads:
        found = [row for rows in threads.map(job, chosen) for row in rows]
    return spark.createDataFrame(
        found,
        "tenant string, entity string, total long, valid long, pass_rate double, passed boolean, seconds double, "
        "records_per_second double, error string",
    )
