"""Curation of files as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clearlot import contracts as C
from clearlot.operators.clean import clean
from clearlot.operators.curate import curated_projection
from clearlot.operators.members import DEFAULT_LIMITS, Limits
from clearlot.operators.references import tag_parts
from clearlot.operators.rules import tag_suppliers
from clearlot.streaming.incremental import load_new_files


def curate_new_files(
    stream: DataFrame,
    entity: str,
    target: str,
    progress: str,
    supplier_ids: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> None:
    """Clean, tag and store every file not yet seen, then stop.

    Exchanged columns are found file by file (``watch_folder`` with ``with_file``), so the result does not depend on how
    many files a batch takes. Rows are stored by validity, so ``is_valid=true`` below ``target`` is the curated part and
    ``is_valid=false`` the quarantine with its reasons. Parts need the ids of valid suppliers.
    """
    if entity == C.PARTS and supplier_ids is None:
        raise ValueError("parts are checked against supplier ids")

    def prepare(batch: DataFrame) -> DataFrame:
        cleaned = clean(batch, entity)
        tagged = tag_suppliers(cleaned) if entity == C.SUPPLIERS else tag_parts(cleaned, supplier_ids, limits=limits)
        return curated_projection(tagged, entity)

    load_new_files(stream, target, progress, prepare, ("is_valid", "tenant_id"))
