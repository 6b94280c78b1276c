"""Flat files for exchange: Parquet and CSV with lists as comma text and geo in a flat shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.lists import geo_to_columns, geo_to_json, is_array, list_to_json, lists_to_text, pin_header, text_to_list
from clearlot.session import remove_folder

# What the database's ten-character unit column can hold of a bad unit.
LONG_UNIT = "INVALID_UOM"
SHORT_UNIT = "INVALID"


def _write(frame: DataFrame, path: str, kind: str, rows_per_file: int | None, mode: str) -> bool:
    """Write in one go. A new folder without rows is taken away again; an old one is not touched for an empty frame."""
    if mode != "errorifexists" and frame.isEmpty():
        return False
    seen = Observation()
    writer = frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "snappy" if kind == "parquet" else "none")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if kind == "csv":
        # Empty text stays an empty field, blanks at the edges stay, and quotes are doubled.
        writer = writer.options(
            header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(kind).save(path)
    if mode == "errorifexists" and seen.get["rows"] == 0:
        remove_folder(frame.sparkSession, path)
        return False
    return True


def flat_split_geo(frame: DataFrame) -> DataFrame:
    return lists_to_text(geo_to_columns(frame))


def flat_json_geo(frame: DataFrame) -> DataFrame:
    return lists_to_text(geo_to_json(frame))


def write_parquet_flat(frame: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Lists as comma text, geo as ``geo_lat`` and ``geo_lon``; an empty frame writes nothing."""
    return _write(flat_split_geo(frame), path, "parquet", None, mode)


def write_parquet_json_geo(frame: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Lists as comma text, geo as JSON text, the form the landing zone expects."""
    return _write(flat_json_geo(frame), path, "parquet", None, mode)


def write_csv_flat(frame: DataFrame, path: str, entity: str, mode: str = "errorifexists") -> bool:
    """Header CSV with geo as JSON text; the parts header is pinned and filled with empty text."""
    flat = flat_json_geo(frame)
    if entity == C.PARTS:
        flat = pin_header(flat, C.columns(C.PARTS))
    return _write(flat, path, "csv", None, mode)


def write_csv_chunked(
    frame: DataFrame, path: str, rows_per_file: int = C.ROWS_PER_FILE, mode: str = "errorifexists"
) -> bool:
    """Header CSV in files of bounded length."""
    return _write(flat_json_geo(frame), path, "csv", rows_per_file, mode)


def stage_for_sql(frame: DataFrame, entity: str) -> DataFrame:
    """Rows as the customer database stores them.

    Column order of the database, lists and geo as JSON text with empty lists as NULL, decimals as double,
    and the over-long bad unit shortened to what its column can hold.
    """
    kinds = dict(frame.dtypes)
    lists = set(C.list_columns(entity))
    out = []
    for name in C.sql_columns(entity):
        value = F.col(name)
        if name in lists:
            items = value if is_array(frame, name) else text_to_list(value)
            value = list_to_json(items)
        elif kinds[name].startswith("struct"):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        elif kinds[name].startswith("decimal"):
            value = value.cast("double")
        elif name == "uom":
            value = F.when(value == LONG_UNIT, F.lit(SHORT_UNIT)).otherwise(value)
        out.append(value.alias(name))
    return frame.select(*out)
