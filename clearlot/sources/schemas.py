"""What columns and types landed files have, and the type that holds the values of several of them."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: where Spark's writer keeps the schema in a file's footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Whole numbers from narrow to wide, with the digits they may have.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
#: Whole numbers that a double holds exactly.
_EXACT_IN_DOUBLE = ("tinyint", "smallint", "int")
_MAX_DIGITS = 38


def _footer(path: str) -> str:
    """The schema of one Parquet file, as Spark writes it in JSON."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    if path.startswith("file:"):
        system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, place = fs.FileSystem.from_uri(quote(path, safe=":/@?=&"))
    with system.open_input_file(place) as source:
        schema = pq.read_schema(source)
    written = (schema.metadata or {}).get(_SPARK_SCHEMA)
    return written.decode() if written else from_arrow_schema(schema).json()


def file_schemas(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, schema`` for every Parquet file under a path or pattern; tasks read the footers, none of the data.

    ``schema`` is NULL where a task cannot open the file, as in a store that only Spark's own readers know. A pattern
    that matches nothing is an error, as for any reader.
    """
    files = spark.read.format("binaryFile").load(pattern).select("path")  # no content is read for the path alone

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    found.append(_footer(path))
                except (OSError, ValueError, NotImplementedError):
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "schema"])

    return files.mapInArrow(task, "path string, schema string")


def schemas_by_file(spark: SparkSession, pattern: str) -> dict[str, T.StructType]:
    """The same on the driver: one job, whatever the number of files. Files that tasks cannot open are asked of Spark."""
    found = {row.path: row.schema for row in file_schemas(spark, pattern).collect()}
    parsed = {text: T.StructType.fromJson(json.loads(text)) for text in set(found.values()) if text}
    unread = [path for path, text in found.items() if not text]
    with ThreadPoolExecutor(8) as several:
        asked = dict(zip(unread, several.map(lambda path: spark.read.parquet(path).schema, unread), strict=True))
    return {path: parsed[text] if text else asked[path] for path, text in sorted(found.items())}


def _wider(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text if there is no other."""
    a, b = one.simpleString(), other.simpleString()
    if a == b or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if a in _WHOLE and b in _WHOLE:
        return one if _WHOLE[a] > _WHOLE[b] else other
    if {a, b} <= {*_EXACT_IN_DOUBLE, "float", "double"}:
        return T.DoubleType()
    digits = [_digits(kind) for kind in (one, other)]
    if all(digits):
        scale = max(places for _, places in digits)
        whole = max(count - places for count, places in digits)
        if whole + scale <= _MAX_DIGITS:
            return T.DecimalType(whole + scale, scale)
    if {a, b} == {"date", "timestamp"} or {a, b} == {"date", "timestamp_ntz"}:
        return one if b == "date" else other
    return T.StringType()


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits in all and after the point of exact numbers."""
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    return (_WHOLE[kind.simpleString()], 0) if kind.simpleString() in _WHOLE else None


def widest(kinds: Iterable[T.DataType]) -> T.DataType:
    """The type for a column that some files hold in one type and some in another.

    Whole numbers widen to longer ones, up to 32 bits to double beside floating-point numbers, and to decimals beside
    decimals; dates to timestamps. Nothing is converted that would lose a digit: long whole numbers or decimals beside doubles,
    like everything else that differs, become text.
    """
    kinds = list(kinds)
    found = reduce(_wider, kinds)
    # a text once reached stays, but other pairs depend on what came before: all must fit in the end
    return found if all(_wider(found, kind) == found for kind in kinds) else T.StringType()


def plain_number(value: Column) -> Column:
    """A floating-point number as text without an exponent, where 38 digits hold it."""
    text = F.regexp_replace(value.cast("double").try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    exact = text.try_cast("double") == value.cast("double")
    return F.when(exact, text).otherwise(value.cast("string"))


def as_type(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``kind`` as ``target``; to text in the notations that the repairs read: lists as comma text,
    structs as JSON, numbers without exponents."""
    if kind.simpleString() == target.simpleString():
        return value
    if not isinstance(target, T.StringType):
        return value.cast(target)
    if isinstance(kind, T.ArrayType):
        return F.array_join(value.cast("array<string>"), ",")
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return plain_number(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value.cast("string")
