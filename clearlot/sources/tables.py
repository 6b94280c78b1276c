"""Curated tables: creation, append, idempotent reload, compaction, inspection."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from contextlib import nullcontext
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.operators.members import DEFAULT_LIMITS, Limits, members_only
from clearlot.operators.merge import upsert_entity
from clearlot.session import fresh_folder, remove_folder, staged


def table_name(entity: str, database: str | None = None) -> str:
    return f"{database}.{C.CURATED_TABLE[entity]}" if database else C.CURATED_TABLE[entity]


def create_curated_table(
    spark: SparkSession,
    entity: str,
    name: str | None = None,
    location: str | None = None,
    file_format: str = "parquet",
    buckets: int = C.CURATED_BUCKETS,
) -> str:
    """Create the curated table unless it exists; returns its name.

    Partitioned by tenant and landing date (parts also by category) and bucketed by primary key, so a tenant's rows are found
    by pruning and key joins between curated tables need no shuffle. Such a join runs with one task per
    bucket: give a table of many terabytes thousands of buckets (``buckets_for``), or 0 for none.

    Files are sorted by the key and carry a Bloom filter of it, so that a search for a few keys reads only the files, row groups
    and pages that may hold them (``rows_of_keys``).
    """
    name = name or table_name(entity)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    kinds = {**C.curated_types(entity), **C.QUALITY_COLUMNS, **C.LINEAGE_COLUMNS}
    body = ", ".join(f"{column} {kind}" for column, kind in kinds.items())
    where = f"LOCATION '{location}'" if location else ""
    key = C.PRIMARY_KEY[entity]
    clustered = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS" if buckets else ""
    blooms = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.adaptive.enabled#{key}": "true"}
    options = ", ".join(f"'{option}' '{value}'" for option, value in blooms.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {file_format} OPTIONS ({options}) "
        f"PARTITIONED BY ({', '.join(C.CURATED_PARTITIONS[entity])}) {clustered} {where} "
        f"TBLPROPERTIES ('parquet.compression' = 'snappy')"
    )
    return name


#: Bytes of one load that a bucket should hold at most, and the most buckets that are chosen for a table.
BUCKET_BYTES, MOST_BUCKETS = 128 * 1024 * 1024, 65_536


def buckets_for(load_bytes: int) -> int:
    """Buckets for a table whose loads have about so many bytes: the default, doubled until a bucket's share is small."""
    buckets = C.CURATED_BUCKETS
    while buckets < MOST_BUCKETS and load_bytes > buckets * BUCKET_BYTES:
        buckets *= 2
    return buckets


def stored_bytes(frame: DataFrame) -> int:
    """The bytes of the files a frame is read from, as Spark's planner knows them; no job runs."""
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_count(spark: SparkSession, name: str) -> int:
    """Buckets of a table, 1 when it has none."""
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return int(described.get("Num Buckets", 1))


def sized_for_write(frame: DataFrame, partitions: tuple[str, ...], key: str, buckets: int) -> DataFrame:
    """Bring rows of one partition and bucket together so that files come out large.

    The rebalance hint lets Spark split a partition that is too big, so a tenant holding a third of all rows
    is written by many tasks, and join small ones.
    """
    bucketed = frame.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
    sized = bucketed.hint("rebalance", *partitions, "_bucket")
    # the writer sorts the files of a bucketed table itself
    return (sized if buckets > 1 else sized.sortWithinPartitions(*partitions, key)).drop("_bucket")


def with_partitions(frame: DataFrame) -> DataFrame:
    """Add what a curated table is partitioned by, and the run, where the frame lacks them.

    The empty text is a tenant like any other, and a file table would store it as NULL; so the key of a tenant is its
    name after ``t_``, and ``null`` where there is none.
    """
    key = F.when(F.col("tenant_id").isNull(), F.lit("null")).otherwise(F.concat(F.lit("t_"), F.col("tenant_id")))
    missing = {"landing_run_id": F.lit(None).cast("string"), "landing_date": F.lit(C.UNDATED)}
    added = {name: value for name, value in missing.items() if name not in frame.columns}
    return frame.withColumns({"tenant_key": key, **added})


def _full_name(spark: SparkSession, name: str) -> str:
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def _writing_session(spark: SparkSession, mode: str, rows_per_file: int = 0) -> SparkSession:
    """A session of its own, so that its settings do not reach other jobs of the caller's."""
    own = spark.newSession()
    for setting in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(setting, spark.conf.get(setting))
    own.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    own.conf.set("spark.sql.files.maxRecordsPerFile", str(rows_per_file))
    return own


def _insert(
    ready: DataFrame,
    entity: str,
    name: str,
    overwrite: bool,
    rows_per_file: int = 0,
    dealt: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Insert a frame that is read from files; with ``overwrite`` the partitions that it has rows for are replaced.

    ``dealt`` brings the rows to the tasks that write them, in place of ``sized_for_write``.
    """
    spark = ready.sparkSession
    path = fresh_folder(spark, "insert")
    ready.write.parquet(path)
    own = _writing_session(spark, "dynamic", rows_per_file)
    name = _full_name(spark, name)
    rows = own.read.schema(ready.schema).parquet(path)
    if dealt is None:
        sized = sized_for_write(rows, C.CURATED_PARTITIONS[entity], C.PRIMARY_KEY[entity], bucket_count(spark, name))
    else:
        sized = dealt(rows)
    sized.select(*spark.table(name).columns).write.insertInto(name, overwrite=overwrite)
    spark.catalog.refreshTable(name)
    remove_folder(spark, path)


def _partitions(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The partitions of a table as its catalog lists them."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [{k: unquote(v) for k, v in (part.split("=", 1) for part in row[0].split("/"))} for row in rows]


def _quoted(values: dict[str, str]) -> str:
    return ", ".join("{} = '{}'".format(k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in values.items())


def _drop_partitions(spark: SparkSession, name: str, chosen: list[dict[str, str]]) -> None:
    """Take partitions out of a table in one statement, then their files, which a table with a location keeps."""
    if not chosen:
        return
    catalog = spark._jsparkSession.sessionState().catalog()
    table_id = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name)
    places = []
    for partition in chosen:
        spec = spark._jvm.PythonUtils.toScalaMap(partition)
        where = catalog.getPartition(table_id, spec).location()  # a URI, in which a path's percent signs are escaped
        places.append(spark._jvm.org.apache.hadoop.fs.Path(where).toString())
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(f'PARTITION ({_quoted(one)})' for one in chosen)}")
    for place in places:
        remove_folder(spark, place)
    spark.catalog.refreshTable(name)


#: Appends to one table commit in one folder, so threads of a driver take turns; replacing them needs no turn.
_appends: dict[str, threading.Lock] = {}
_appends_lock = threading.Lock()


def _turn(place: str) -> threading.Lock:
    """The lock of a table, by its full name, or of a folder."""
    with _appends_lock:
        return _appends.setdefault(place, threading.Lock())


def append_rows(
    frame: DataFrame,
    entity: str,
    name: str,
    replace: bool = False,
    rows_per_file: int = 0,
    replaced: DataFrame | None = None,
) -> None:
    """Append rows by column name. A second run of the same input adds them again.

    With ``replace`` the tenants and landing dates of the frame, and those of ``replaced`` (columns ``tenant_key`` and
    ``landing_date``), are replaced exactly: what they held before is gone, also where they have no row now, and nothing
    else is touched. ``rows_per_file`` caps the length of a file; 0 sets no cap.
    """
    spark = frame.sparkSession
    ready = with_partitions(frame).select(*spark.table(name).columns)
    if not replace and not rows_per_file:
        partitions = C.CURATED_PARTITIONS[entity]
        sized = sized_for_write(ready, partitions, C.PRIMARY_KEY[entity], bucket_count(spark, name))
        with _turn(_full_name(spark, name)):
            sized.write.insertInto(name)
        return
    ready = staged(ready, "append")
    stale = []
    if replace:
        parts = list(C.CURATED_PARTITIONS[entity])
        written = ready.select(*parts).distinct()
        pairs = written.select("tenant_key", "landing_date")
        if replaced is not None:
            pairs = pairs.unionByName(replaced.select("tenant_key", "landing_date"))
        # A row for each tenant and date of the run, and for each partition that it writes.
        chosen = {tuple(row) for row in pairs.distinct().collect()}
        kept = {tuple(row) for row in written.collect()}
        stale = [
            one
            for one in _partitions(spark, name)
            if (one["tenant_key"], one["landing_date"]) in chosen and tuple(one[part] for part in parts) not in kept
        ]
    with nullcontext() if replace else _turn(_full_name(spark, name)):
        _insert(ready, entity, name, replace, rows_per_file)
    # new rows are there before old ones go, so a crash in between leaves rows of before, not holes
    _drop_partitions(spark, name, stale)


#: Keys of a batch that are searched one by one; for more of them the key column is read and joined.
POINT_KEYS = 2_000


def rows_of_keys(spark: SparkSession, name: str, key: str, keys: Iterable[str]) -> DataFrame:
    """The rows of a table that have one of a few keys, read from the files, row groups and pages that may hold them.

    The keys are pushed into the scan, where buckets, the files' Bloom filters and the sorted pages rule out the rest.
    """
    wanted = sorted(set(keys))
    own = _writing_session(spark, "static")
    own.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(max(10, len(wanted))))
    own.conf.set("spark.sql.optimizer.inSetConversionThreshold", str(max(10, len(wanted))))
    return own.table(_full_name(spark, name)).where(F.col(key).isin(wanted))


def _holding(batch: DataFrame, key: str, name: str, partitions: list[str], limits: Limits) -> DataFrame:
    """The partitions of a table that hold a key of the batch."""
    spark = batch.sparkSession
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    few = [row[0] for row in keys.limit(POINT_KEYS + 1).collect()]
    if len(few) > POINT_KEYS:
        base = spark.table(name).select(key, *partitions)
        return members_only(base, key, batch.select(key), limits).select(*partitions).distinct()
    found = rows_of_keys(spark, name, key, few).select(*partitions).distinct()
    place = fresh_folder(spark, "holding")
    found.write.parquet(place)
    return spark.read.schema(found.schema).parquet(place)


def upsert_rows(batch: DataFrame, entity: str, name: str, limits: Limits = DEFAULT_LIMITS) -> None:
    """Update a curated table by primary key: new keys are added, of known ones the updatable columns change.

    Only the partitions that hold a key of the batch, or that the batch adds to, are read in full and
    rewritten; they are found by the keys themselves while these are few, else by the key column of the table. Running it
    twice changes nothing more.
    """
    spark = batch.sparkSession
    key, partitions = C.PRIMARY_KEY[entity], list(C.CURATED_PARTITIONS[entity])
    base = spark.table(name)
    batch = staged(with_partitions(batch).select(*base.columns), "upsert-batch")
    holding = _holding(batch, key, name, partitions, limits)
    touched = holding.unionByName(batch.select(*partitions)).distinct()
    touched = touched.withColumnsRenamed({part: f"_{part}" for part in partitions})
    same = reduce(lambda a, b: a & b, [F.col(part).eqNullSafe(F.col(f"_{part}")) for part in partitions])
    merged = upsert_entity(base.join(touched, same, "left_semi"), batch, entity, limits)
    _insert(staged(merged.select(*base.columns), "upsert"), entity, name, overwrite=True)


def overwrite_partitions(frame: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """The same idempotent reload for a table kept as a plain folder."""
    balanced = frame.hint("rebalance", *partitions)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def file_sizes(spark: SparkSession, name: str, entity: str, values: dict[str, str] | None = None) -> DataFrame:
    """``bucket``, ``path`` and ``bytes`` of every file of the chosen partitions, beside the partition columns.

    No column is read for it; the bucket is the one in the file's name.
    """
    chosen = spark.table(name)
    for column, value in (values or {}).items():
        chosen = chosen.where(F.col(column) == value)
    path = F.col("_metadata.file_path")
    bucket = F.coalesce(F.regexp_extract(path, r"_(\d+)(?:\.[^/]*)?$", 1).try_cast("int"), F.lit(0)).alias("bucket")
    size = F.col("_metadata.file_size").alias("bytes")
    return chosen.select(*C.CURATED_PARTITIONS[entity], bucket, path.alias("path"), size).distinct()


def compact_partitions(
    spark: SparkSession,
    name: str,
    entity: str,
    values: dict[str, str] | None = None,
    target_bytes: int = 128 * 1024 * 1024,
) -> DataFrame:
    """Rewrite the partitions that are in too many files, rows unchanged; returns them with their files before and after.

    Of the partitions with the given values, or of all, those are rewritten of which some bucket takes twice the files of
    ``target_bytes`` that its bytes would fill; the others are left alone. Only partition columns can be named. The rows go
    through the shared folder first, because a table cannot be overwritten while it is read; a hash of the key deals those of
    a bucket to as many tasks as it gets files.
    """
    values = values or {}
    partitions = list(C.CURATED_PARTITIONS[entity])
    if unknown := set(values) - set(partitions):
        raise ValueError(f"no partition columns: {', '.join(sorted(unknown))}")
    key, buckets = C.PRIMARY_KEY[entity], bucket_count(spark, name)
    filled = F.greatest(F.ceil(F.sum("bytes") / target_bytes), F.lit(1)).alias("after")
    files = file_sizes(spark, name, entity, values).groupBy(*partitions, "bucket").agg(F.count("*").alias("before"), filled)
    totals = files.groupBy(*partitions).agg(
        F.sum("before").alias("before"), F.sum("after").alias("after"), F.max(F.col("before") >= 2 * F.col("after")).alias("many")
    )
    chosen = totals.where("many").drop("many")
    spread = staged(files.join(chosen.select(*partitions), partitions, "left_semi"), "compact-files")
    chosen = spread.groupBy(*partitions).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    made = spread.agg(F.sum("after")).first()[0]
    if made:
        rows = spark.table(name).withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        wanted = spread.select(*[F.col(part).alias(f"_{part}") for part in partitions], F.col("bucket").alias("_of"), "after")
        same = reduce(lambda a, b: a & b, [F.col(part).eqNullSafe(F.col(f"_{part}")) for part in partitions])
        rows = rows.join(wanted, same & (F.col("_bucket") == F.col("_of")))
        rows = rows.withColumn("_file", F.pmod(F.xxhash64(key), F.col("after")))
        ready = staged(rows.select(*spark.table(name).columns, "_bucket", "_file"), "compact")
        tasks = min(int(made), MOST_BUCKETS)
        _insert(ready, entity, name, overwrite=True, dealt=lambda frame: frame.repartition(tasks, *partitions, "_bucket", "_file"))
    return chosen


def write_rejects(frame: DataFrame, path: str, replace: bool = False, replaced: DataFrame | None = None) -> None:
    """Add rejected rows to a folder by tenant and landing date; ``replace`` works as in ``append_rows``."""
    spark = frame.sparkSession
    ready = with_partitions(frame)
    keys = ["tenant_key", "landing_date"]
    if replace:
        ready = staged(ready, "rejects")
        written = ready.select(*keys).distinct()
        pairs = written if replaced is None else written.unionByName(replaced.select(*keys))
        quoted = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for tenant, date in {tuple(row) for row in pairs.collect()} - {tuple(row) for row in written.collect()}:
            remove_folder(spark, f"{path}/tenant_key={quoted(tenant)}/landing_date={quoted(date)}")
    writer = ready.hint("rebalance", *keys).write.partitionBy(*keys)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    with nullcontext() if replace else _turn(path):
        writer.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def has_struct_column(spark: SparkSession, name: str, column: str = "geo_coords") -> bool:
    return dict(spark.table(name).dtypes).get(column, "").startswith("struct")
