"""Incremental loading as a stream: each file of the landing zone is processed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def watch_folder(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str | None = None, files_per_batch: int | None = None,
    with_file: bool = False,
) -> DataFrame:
    """A stream of the Parquet files that are or will be below ``path``, a bounded number at a time if wanted.

    ``source_file`` names each row's file, with ``with_file``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.parquet(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path")) if with_file else rows


def load_new_files(
    stream: DataFrame,
    target: str,
    progress: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Append all files not yet seen to ``target`` and stop.

    ``progress`` remembers the files. A micro-batch goes into its own folder ``batch=<n>`` and overwrites it,
    so a batch repeated after a failure does not add its rows twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        writer = prepare(batch).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{target}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
