"""Upserts, duplicate removal and incremental selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.operators.members import DEFAULT_LIMITS, Limits, flag_members, measure
from clearlot.session import staged


class RepeatedKeyError(ValueError):
    """An update batch names the same key twice."""


def _reject_repeats(batch: DataFrame, key: str) -> int:
    """Rows of the batch, after making sure no key occurs twice."""
    totals = (
        batch.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"))
        .first()
    )
    if totals["repeated"]:
        raise RepeatedKeyError(f"{totals['repeated']} values of {key} occur more than once in the batch")
    return int(totals["rows"])


def _with_prefix(frame: DataFrame, prefix: str) -> DataFrame:
    return frame.select(*[F.col(name).alias(prefix + name) for name in frame.columns])


def _with_flag(frame: DataFrame, flag: str) -> DataFrame:
    return frame.withColumn(flag, F.lit(True))


def upsert_update(
    base: DataFrame, batch: DataFrame, key: str, update_columns: Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Insert new keys, update ``update_columns`` of known ones, keep everything else.

    A NULL in an update column overwrites, which is why presence is flagged rather than read off the value.
    A batch that repeats a key is refused. A small batch is broadcast and the base is not shuffled; otherwise
    both sides meet in one full outer join, whose keys are unique on either side.
    """
    names = base.columns
    rows = _reject_repeats(batch, key)
    new = _with_flag(_with_prefix(batch.select(*names), "_new_"), "_has_new")
    has_new = F.col("_has_new").isNotNull()

    def merged(name: str, otherwise: Column) -> Column:
        if name in update_columns:
            return F.when(has_new, F.col("_new_" + name)).otherwise(otherwise).alias(name)
        return otherwise.alias(name)

    if rows <= limits.broadcast_rows and measure(batch.select(*names)).fits(limits):
        updated = base.join(F.broadcast(new), F.col(key) == F.col("_new_" + key), "left")
        kept = updated.select(*[merged(name, F.col(name)) for name in names])
        batch_keys = batch.select(F.col(key).alias("_key"))
        seen = base.select(key).join(F.broadcast(batch_keys), F.col(key) == F.col("_key"), "left_semi").distinct()
        added = batch.select(*names).join(F.broadcast(seen), key, "left_anti").select(*names)
        return kept.unionByName(added)

    old = _with_flag(base, "_has_old")
    joined = old.join(new, F.col(key) == F.col("_new_" + key), "full_outer")
    has_old = F.col("_has_old").isNotNull()
    return joined.select(
        *[merged(name, F.when(has_old, F.col(name)).otherwise(F.col("_new_" + name))) for name in names]
    )


def one_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. NULL keys form one group.

    Keeping only rank 1 lets Spark drop all but one row per key and task before the shuffle, so a key holding
    a third of all rows costs no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def upsert_ignore(base: DataFrame, batch: DataFrame, key: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Insert only new keys. Of rows repeating a key inside the batch the smallest survives.

    The whole row orders the candidates, so the survivor does not depend on row order.
    """
    names = base.columns
    single = one_per_key(batch.select(*names), [key], [F.col(name) for name in names])
    if measure(single.select(key)).fits(limits):
        batch_keys = single.select(F.col(key).alias("_key"))
        seen = base.select(key).join(F.broadcast(batch_keys), F.col(key) == F.col("_key"), "left_semi").distinct()
        added = single.join(F.broadcast(seen), key, "left_anti")
    else:
        added = single.join(base.select(key), key, "left_anti")
    return base.unionByName(added.select(*names))


def upsert_entity(base: DataFrame, batch: DataFrame, entity: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The update the customer database makes: only the columns that may change are taken from the batch."""
    return upsert_update(base, batch, C.PRIMARY_KEY[entity], C.SQL_UPDATE_COLUMNS[entity], limits)


def concat_runs(runs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all runs, matched by column name; columns a run lacks become NULL."""
    first, *rest = runs
    for run in rest:
        first = first.unionByName(run, allowMissingColumns=True)
    return first


def dedupe_latest(
    frame: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key; ties go to the greatest ``tie_break`` columns, then to the greatest rest."""
    named = [newest, *tie_break]
    rest = [name for name in frame.columns if name not in named and name not in keys]
    return one_per_key(frame, keys, [F.desc(name) for name in [*named, *rest]])


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows in ``rows``."""
    return frame.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def flag_duplicates(
    frame: DataFrame, keys: Sequence[str], flag: str, limits: Limits = DEFAULT_LIMITS, stage: bool = True
) -> DataFrame:
    """Add boolean ``flag``: whether another row has the same, completely non-NULL key.

    The repeated keys are written once to the shared folder; without ``stage`` they are worked out twice, once
    for counting and once for joining.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    keyed = frame.withColumn("_key", F.when(whole, F.to_json(F.struct(*keys))))
    repeated = repeated_keys(keyed.where(F.col("_key").isNotNull()), ["_key"]).select("_key")
    if stage:
        repeated = staged(repeated, "repeated-keys")
    return flag_members(keyed, "_key", repeated, flag, limits).drop("_key")


def fresh_rows(frame: DataFrame, as_of: Column, name: str = "source_timestamp") -> DataFrame:
    """Rows whose source time does not lie after ``as_of``; rows without one are kept."""
    return frame.where(F.col(name).isNull() | (F.col(name) <= as_of))


def incremental_rows(
    source: DataFrame, target: DataFrame, cursor: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Source rows newer than anything in the target; all of them while the target is empty.

    With ``keys``, rows that arrive late at the very moment the target has reached are among them too, unless the target has
    a row of that key and moment: only the target's rows of that moment are looked at. Rows without a cursor value are
    always among them, as nothing tells that they were loaded before; load them with an upsert. The cursor is a scalar
    subquery, so it is read when the result is computed.
    """
    reached = target.agg(F.max(cursor)).scalar()
    open_rows = reached.isNull() | F.col(cursor).isNull()
    if not keys:
        return source.where(open_rows | (F.col(cursor) > reached))
    last = target.where(F.col(cursor) == reached)
    last = last.select(F.col(cursor).alias("_reached"), *[F.col(key).alias(f"_loaded_{key}") for key in keys]).distinct()
    same = F.col(cursor) == F.col("_reached")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_loaded_{key}"))
    return source.where(open_rows | (F.col(cursor) >= reached)).join(last, same, "left_anti")
