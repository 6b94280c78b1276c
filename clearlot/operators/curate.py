"""From tagged rows to curated and quarantined ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.lists import is_array, list_to_text
from clearlot.operators.clean import repair_geo, whole_number
from clearlot.operators.rules import valid_rows


def curated_projection(tagged: DataFrame, entity: str) -> DataFrame:
    """Curated columns in table order with table types.

    ``data_source`` is always overwritten and the ingestion time is the time of writing. Landing date and run go along
    where the rows have them.
    """
    frame = repair_geo(tagged) if entity == C.SUPPLIERS else tagged
    kinds = dict(frame.dtypes)
    out = []
    for name, kind in {**C.curated_types(entity), **C.QUALITY_COLUMNS}.items():
        value = F.col(name) if name in kinds else F.lit(None).cast(kind)
        if name == "data_source":
            value = F.lit(C.DATA_SOURCE)
        elif name == "ingestion_timestamp":
            value = F.current_timestamp()
        elif kind == "string" and name in kinds and is_array(frame, name):
            value = list_to_text(value)
        elif kind == "int" and name in kinds:
            value = whole_number(value, kinds[name] == "string")
        elif kind in ("double", "decimal(18,6)", "timestamp"):
            value = value.try_cast(kind)
        out.append(value.alias(name))
    return frame.select(*out, *[name for name in ("landing_run_id", "landing_date") if name in kinds])


def curated_rows(tagged: DataFrame, entity: str) -> DataFrame:
    return curated_projection(valid_rows(tagged), entity)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    """Invalid rows as they came, with the reasons."""
    return tagged.where("NOT is_valid")
