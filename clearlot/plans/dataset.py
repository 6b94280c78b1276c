"""Make a test data set: suppliers, parts, optional damage, files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clearlot import contracts as C
from clearlot.operators.dirt import inject_anomalies
from clearlot.operators.synth import FAST, FULL, ids_from_range, spread, synth_parts, synth_suppliers
from clearlot.session import staged
from clearlot.sources.exports import stage_for_sql, write_csv_flat, write_parquet_flat, write_parquet_json_geo
from clearlot.sources.landing import run_folder


@dataclass(frozen=True)
class Dataset:
    suppliers: DataFrame
    parts: DataFrame
    dirty_rate: float


def make_dataset(
    spark: SparkSession,
    suppliers: int | DataFrame,
    parts: int | DataFrame,
    seed: int = 42,
    tenant: str = "tenant_a",
    dirty_rate: float = 0.06,
    as_of: str | None = None,
    variant: str = FULL,
) -> Dataset:
    """Suppliers and parts; damage spares foreign keys in the fast variant. Rate 0 leaves the data clean.

    Both are given as a number of rows, or as a frame with one column of distinct keys, one for each row to make.
    """
    if any(isinstance(rows, int) and rows < 1 for rows in (suppliers, parts)):
        raise ValueError("row counts must be positive")
    if not 0.0 <= dirty_rate <= 1.0:
        raise ValueError("the dirty rate lies between 0 and 1")
    supplier_ids = ids_from_range(spark, suppliers) if isinstance(suppliers, int) else spread(suppliers)
    part_ids = ids_from_range(spark, parts) if isinstance(parts, int) else parts
    made = synth_suppliers(supplier_ids, seed, tenant, as_of, variant)
    parents = suppliers if isinstance(suppliers, int) else made.select("supplier_id")
    suppliers, parts = made, synth_parts(part_ids, parents, seed, tenant, as_of, variant)
    if dirty_rate:
        fast = variant == FAST
        suppliers = inject_anomalies(suppliers, C.SUPPLIERS, dirty_rate, seed, as_of=as_of, fast=fast)
        parts = inject_anomalies(parts, C.PARTS, dirty_rate, seed, as_of=as_of, fast=fast)
    return Dataset(suppliers, parts, dirty_rate)


def export_dataset(data: Dataset, folder: str) -> Dataset:
    """CSV and Parquet exchange files plus rows staged for the customer database, from one evaluation."""
    kept = Dataset(
        staged(data.suppliers, "made-suppliers"), staged(data.parts, "made-parts"), data.dirty_rate
    )
    for entity, frame in ((C.SUPPLIERS, kept.suppliers), (C.PARTS, kept.parts)):
        write_csv_flat(frame, f"{folder}/{entity}.csv", entity)
        write_parquet_flat(frame, f"{folder}/{entity}.parquet")
        stage_for_sql(frame, entity).write.parquet(f"{folder}/sql/{entity}")
    return kept


def land_dataset(data: Dataset, root: str, tenant: str, run_date: str, run_id: str) -> None:
    """Write the landing files the curation job reads."""
    for entity, frame in ((C.SUPPLIERS, data.suppliers), (C.PARTS, data.parts)):
        write_parquet_json_geo(frame, run_folder(root, tenant, entity, run_date, run_id))
