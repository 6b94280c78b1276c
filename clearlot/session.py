"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results do not depend on these; they only keep timestamps in UTC and let Spark re-plan at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.scheduler.mode": "FAIR",
}


def local_session(cores: int | str = 8, name: str = "clearlot", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        return folder.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clearlot-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/clearlot/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries within leave no shuffle files behind, so the disk holds those of one step, not of all steps before it.

    Sessions count the blocks that are open, and the last one to end puts the setting back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        open_blocks = _cleaning.setdefault(session, [0, spark.conf.get(_CLEANUP)])
        open_blocks[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            open_blocks[0] -= 1
            if not open_blocks[0]:
                spark.conf.set(_CLEANUP, open_blocks[1])
                del _cleaning[session]


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is started within; what was set before holds again afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged(frame: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``frame`` once to the shared folder and read it back.

    Several outputs can then be made from one evaluation, and a lost executor costs only its own tasks,
    because what was written no longer depends on the executors that computed it. The shuffle files of the step go
    with it.
    """
    spark = frame.sparkSession
    path = fresh_folder(spark, label)
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unstaged(frame: DataFrame) -> None:
    """Delete what ``staged`` wrote for ``frame``, which nothing may read any more."""
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        remove_folder(frame.sparkSession, folder)
