"""List columns as text and back, geo coordinates in their three shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as white space around a list element. Spark's trim knows blanks only.
WHITE_SPACE = (
    " \t\n\u000b\u000c\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def text_to_list(value: Column) -> Column:
    """``a, b``, ``["a","b"]`` and ``['a','b']`` as an array without empty elements; NULL stays NULL."""
    unbracketed = F.translate(F.btrim(value, F.lit("[]")), "\"'", "")
    bare = F.when(value.startswith("["), unbracketed).otherwise(value)
    return F.filter(F.transform(F.split(bare, ","), strip_space), lambda item: item != "")


def as_list(frame: DataFrame, name: str) -> Column:
    """Column ``name`` as an array, whether it is stored as text or already as an array."""
    return F.col(name) if is_array(frame, name) else text_to_list(F.col(name))


def is_array(frame: DataFrame, name: str) -> bool:
    return dict(frame.dtypes)[name].startswith("array")


def list_to_text(value: Column) -> Column:
    """Comma text; an empty or missing list becomes the empty string."""
    return F.coalesce(F.array_join(value, ","), F.lit(""))


def list_to_json(value: Column) -> Column:
    """JSON text for the customer database; an empty list becomes NULL."""
    return F.when(F.size(value) > 0, F.to_json(value))


def lists_to_text(frame: DataFrame) -> DataFrame:
    """Every array column of the frame as comma text."""
    arrays = [name for name, kind in frame.dtypes if kind.startswith("array")]
    return frame.withColumns({name: list_to_text(F.col(name)) for name in arrays})


def geo_to_columns(frame: DataFrame, geo: str = "geo_coords") -> DataFrame:
    """Replace the geo struct by ``geo_lat`` and ``geo_lon``; frames without one pass unchanged."""
    if not dict(frame.dtypes).get(geo, "").startswith("struct"):
        return frame
    return frame.withColumns({"geo_lat": F.col(f"{geo}.lat"), "geo_lon": F.col(f"{geo}.lon")}).drop(geo)


def geo_to_json(frame: DataFrame, geo: str = "geo_coords") -> DataFrame:
    """Replace the geo struct by JSON text; frames without one pass unchanged."""
    if not dict(frame.dtypes).get(geo, "").startswith("struct"):
        return frame
    return frame.withColumn(geo, F.to_json(F.col(geo), {"ignoreNullFields": "false"}))


def pin_header(frame: DataFrame, names: list[str]) -> DataFrame:
    """Exactly ``names`` in that order; absent columns are filled with the empty string."""
    return frame.select([F.col(name) if name in frame.columns else F.lit("").alias(name) for name in names])
