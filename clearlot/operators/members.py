"""Key membership: does a row's key occur in another table?

The key table is broadcast only when it has been counted and fits. Beyond that the distinct keys are answered first, and
the shorter of the two answers is broadcast if it fits. Only beyond that are rows shuffled, with the most frequent keys of
the big side answered from a small broadcast table, so that one key holding a third of all rows is never gathered in one
task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot.session import staged


@dataclass(frozen=True)
class Limits:
    """Bounds for broadcast tables, and what makes a key a frequent one: its rows, and its rank by rows."""

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    frequent_rows: int = 100_000
    frequent_keys: int = 2_000


DEFAULT_LIMITS = Limits()


@dataclass(frozen=True)
class Measure:
    rows: int
    bytes: int

    def fits(self, limits: Limits) -> bool:
        return self.rows <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def measure(frame: DataFrame) -> Measure:
    """Rows and text bytes of a (narrow) frame, in one aggregate."""
    width = F.lit(0).cast("long")
    for name, kind in frame.dtypes:
        text = F.col(name) if kind == "string" else F.to_json(F.struct(name))
        width = width + F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    row = frame.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return Measure(int(row["rows"]), int(row["bytes"]))


def key_answers(frame: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """``_asked, _n, _hit`` for every distinct key of the frame: its rows, and whether it occurs in ``members``.

    Only keys are shuffled, counted by task first, so a key of a third of all rows is one row like any other. The
    answers are written once to the shared folder.
    """
    (name,) = members.columns
    asked = frame.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_asked")).agg(F.count("*").alias("_n"))
    known = members.select(F.col(name).alias("_member")).distinct()
    joined = asked.join(known, F.col("_asked") == F.col("_member"), "left")
    return staged(joined.select("_asked", "_n", F.col("_member").isNotNull().alias("_hit")), "answers")


def _sizes(answers: DataFrame) -> dict[bool, Measure]:
    """How many keys are members and how many are not, and their bytes."""
    found = {True: Measure(0, 0), False: Measure(0, 0)}
    width = F.octet_length(F.col("_asked").cast("string")).cast("long")
    for row in answers.groupBy("_hit").agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).collect():
        found[row["_hit"]] = Measure(int(row["rows"]), int(row["bytes"]))
    return found


def flag_members(
    frame: DataFrame,
    key: str,
    members: DataFrame,
    flag: str,
    limits: Limits = DEFAULT_LIMITS,
    size: Measure | None = None,
) -> DataFrame:
    """Add boolean ``flag``: whether ``key`` occurs in the one-column frame ``members``.

    Rows are neither lost nor repeated. A NULL key is no member. ``size`` may be passed when the caller has
    already counted the members; repeated members may be included in it.

    Members that fit are broadcast. Otherwise every distinct key is answered first, and if the members or the others among
    these keys fit, they are broadcast and the rows stay where they are: usually few keys are orphans, however many there
    are in all. Only when both are many do the rows meet the answers in a shuffle.
    """
    (name,) = members.columns
    filled = members.where(F.col(name).isNotNull()).select(F.col(name).alias("_member"))
    size = size or measure(filled)
    if size.fits(limits):
        marked = filled.distinct().withColumn("_hit", F.lit(True))
        joined = frame.join(F.broadcast(marked), F.col(key) == F.col("_member"), "left")
        return joined.withColumn(flag, F.col("_hit").isNotNull()).drop("_member", "_hit")

    answers = key_answers(frame, key, filled)
    sizes = _sizes(answers)
    fitting = [hit for hit in (False, True) if sizes[hit].fits(limits)]
    if fitting:
        told = min(fitting, key=lambda hit: sizes[hit].rows)
        marked = answers.where(F.col("_hit") if told else ~F.col("_hit")).select("_asked", F.lit(True).alias("_told"))
        joined = frame.join(F.broadcast(marked), F.col(key) == F.col("_asked"), "left")
        found = F.col("_told").isNotNull() if told else F.col(key).isNotNull() & F.col("_told").isNull()
        return joined.withColumn(flag, found).drop("_asked", "_told")

    often = (
        answers.where(F.col("_n") >= limits.frequent_rows)
        .orderBy(F.desc("_n"), "_asked")
        .limit(limits.frequent_keys)
        .select(F.col("_asked").alias("_often"), F.col("_hit").alias("_often_hit"))
    )
    tagged = frame.join(F.broadcast(often), F.col(key) == F.col("_often"), "left")
    # Answered rows need no partner: a spread value no member carries keeps them out of the key's partition.
    answered = F.col("_often").isNotNull() | F.col(key).isNull()
    spread = F.when(answered, F.spark_partition_id().cast("long") + 1).otherwise(F.lit(0).cast("long"))
    # Always 0, but not a constant, which the optimizer would take out of the join key.
    zero = F.pmod(F.xxhash64("_asked"), F.lit(1).cast("long"))
    rest = answers.where("_hit").select(F.col("_asked").alias("_member"), zero.alias("_zero"), "_hit")
    joined = tagged.withColumn("_spread", spread).join(
        rest, (F.col(key) == F.col("_member")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    found = F.col("_hit").isNotNull() | F.coalesce("_often_hit", F.lit(False))
    return joined.withColumn(flag, found).drop("_often", "_often_hit", "_spread", "_member", "_zero", "_hit")


def members_only(frame: DataFrame, key: str, members: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return flag_members(frame, key, members, "_known", limits).where("_known").drop("_known")


def orphans(frame: DataFrame, key: str, members: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows whose key does not occur in ``members``; a NULL key is an orphan."""
    return flag_members(frame, key, members, "_known", limits).where("NOT _known").drop("_known")
