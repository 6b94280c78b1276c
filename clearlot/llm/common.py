"""What the corpus operators share: tables, text columns and batches of rows for Python tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearlot.session import session_setting, staged

#: Rows that a task hands back at once, and the characters of input after which it does so earlier.
ROWS_AT_ONCE = 500
CHARS_AT_ONCE = 2_000_000

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def then_given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; the memory it has freed goes back to the system when it ends.

    Python workers stay for later tasks, and else hold on to what their largest batches took while others need it.
    """
    yield from batches
    del batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # only the GNU C library has it
        pass


def in_python(
    frame: DataFrame,
    schema: T.StructType,
    work: Callable[[], Callable[..., tuple]],
    measure: int | None = None,
) -> DataFrame:
    """One result row for each row of ``frame``, made in Python tasks.

    ``work()`` is called once in each task and returns the function of a row's values. The task hands back at most
    ROWS_AT_ONCE rows at once, fewer when the texts in column number ``measure`` are long, so its memory stays bounded.
    """

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        row = work()
        made: list[tuple] = []
        chars = 0

        def packed() -> pa.RecordBatch:
            columns = zip(*made, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow, strict=True)],
                schema=arrow,
            )

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for values in zip(*(column.to_pylist() for column in part.columns), strict=True):
                    made.append(row(*values))
                    if measure is not None:
                        chars += len(values[measure] or "")
                    if len(made) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
                        yield packed()
                        made, chars = [], 0
        if made:
            yield packed()

    return frame.mapInArrow(lambda batches: then_given_back(results(batches)), schema)


def staged_small(frame: DataFrame, label: str) -> DataFrame:
    """``staged``, with Arrow batches of at most ROWS_AT_ONCE rows between Spark and Python: whole texts make large ones."""
    with session_setting(frame.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE)):
        return staged(frame, label)


def schema_of(*fields: str) -> T.StructType:
    """A schema from texts such as ``"doc_id long"``."""
    return T.StructType.fromDDL(", ".join(fields))


def id_field(frame: DataFrame, column: str) -> str:
    return f"{column} {frame.schema[column].dataType.simpleString()}"
