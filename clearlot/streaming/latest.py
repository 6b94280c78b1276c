"""The newest row of every key, kept up to date by a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearlot.operators.merge import dedupe_latest

#: What is kept of a batch below the progress folder: its newest moment, in microseconds, and its rows that came too late.
NOTES = "newest long, late long, batch long"


def _span_end(micros: Column, span: str) -> Column:
    """The end of the span a moment lies in, in microseconds; spans are counted from 1970 on."""
    length = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.lit(span).cast("interval"))
    return micros - F.pmod(micros, length) + length


def _forgotten(spark: SparkSession, notes: str, number: int, delay: str) -> int | None:
    """The moment, in microseconds, up to which spans are forgotten when a batch starts; None in the first one."""
    if not number:
        return None
    earlier = spark.read.schema(NOTES).parquet(notes).where(F.col("batch") < number)
    reached = F.timestamp_micros(F.max("newest"))
    return earlier.agg(F.unix_micros(reached - F.lit(delay).cast("interval"))).first()[0]


def load_latest(
    stream: DataFrame,
    target: str,
    progress: str,
    keys: Sequence[str],
    newest: str,
    tie_break: Sequence[str] = (),
    delay: str = "30 days",
    span: str = "1 day",
) -> int:
    """Keep the newest row of each key among all files not yet seen, then stop; returns the rows that came too late.

    Each micro-batch writes its newest row of each key into its own folder ``batch=<n>``, and overwrites it when it is
    repeated after a failure. Nothing of a row is held between batches, so memory does not grow with the keys; a note of
    each batch tells its newest moment. A ``span`` of time is forgotten once a batch before has had a moment ``delay`` after
    its end; rows of forgotten spans are counted and not taken. Rows without a time are never too late.
    ``latest_rows`` reads the result, which is what ``dedupe_latest`` makes of all rows that were in time.
    """
    notes, late = f"{progress}/notes", []
    micros = F.unix_micros(F.col(newest).cast("timestamp"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        forgotten = _forgotten(spark, notes, number, delay)
        gone = F.lit(False)
        if forgotten is not None:
            gone = F.coalesce(_span_end(micros, span) <= F.lit(forgotten), F.lit(False))
        seen = Observation()
        told = batch.observe(seen, F.max(micros).alias("newest"), F.count_if(gone).alias("late"))
        rows = dedupe_latest(told.where(~gone), keys, newest, tie_break)
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")
        found = seen.get
        note = spark.createDataFrame([(found["newest"], found["late"])], "newest long, late long")
        note.coalesce(1).write.mode("overwrite").parquet(f"{notes}/batch={number}")
        late.append(int(found["late"]))

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{progress}/files")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(late)


def latest_rows(
    spark: SparkSession, target: str, schema: T.StructType, keys: Sequence[str], newest: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key that ``load_latest`` has written."""
    written = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)
    return dedupe_latest(written, keys, newest, tie_break)
