"""Controlled damage: an exact share of rows gets one anomaly each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.draws import Draws, record_id
from clearlot.functions.lookups import iso_utc
from clearlot.operators.synth import number_rows
from clearlot.session import staged

# Anomaly kinds and what they write.
KINDS = {
    C.SUPPLIERS: ("out_of_range_rate", "missing_contact", "bogus_country", "duplicate_code", "future_timestamp"),
    C.PARTS: ("invalid_supplier_id", "negative_cost", "wrong_uom", "duplicate_part_number", "future_timestamp"),
}
FAST_KINDS = {
    C.SUPPLIERS: ("out_of_range_rate", "missing_contact", "bogus_country", "future_timestamp"),
    C.PARTS: ("negative_cost", "wrong_uom", "future_timestamp"),
}
COPY_KIND = {C.SUPPLIERS: "duplicate_code", C.PARTS: "duplicate_part_number"}
OUT_OF_RANGE_RATE = 104.0
WRONG_UNIT = "INVALID_UOM"
FAST_WRONG_UNIT = "INVALID"

#: Bits of the hash that one step of the search looks at, and rows that one task may rank in the end.
_STEP_BITS = 16
_RANKED_ROWS = 10_000


def _last_drawn(hashes: DataFrame, wanted: int) -> tuple[int, int, int]:
    """The last of the ``wanted`` least values of column ``h``, how many rows have it and how many of these are drawn.

    Nothing is sorted as a whole. Counts by leading bits tell in which range the last row lies; the range is narrowed by
    further bits until it is small. Each step returns one row to the driver.
    """
    for known in range(_STEP_BITS, 65, _STEP_BITS):
        bucket = F.shiftright("h", 64 - known)
        counts = hashes.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))  # 65536 rows at most
        reached = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
        edge = counts.withColumn("_reached", reached).where(F.col("_reached") >= wanted).orderBy("_bucket").first()
        wanted -= edge["_reached"] - edge["_n"]
        hashes = hashes.where(bucket == edge["_bucket"])
        if edge["_n"] <= _RANKED_ROWS:
            break
    reached = F.sum("_n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0))
    ranks = hashes.groupBy("h").agg(F.count("*").alias("_n")).withColumn("_reached", reached)
    last = ranks.where(F.col("_reached") >= wanted).orderBy("h").first()
    return last["h"], last["_n"], wanted - (last["_reached"] - last["_n"])


def _draw(frame: DataFrame, key: str, rate: float, seed: int) -> tuple[Column, Column | None, int]:
    """A condition for the rows surely drawn, one for rows that are alike in every column, and how many of these are."""
    hashed = F.xxhash64(F.col(key), F.lit(seed), F.lit("sample"))
    hashes = staged(frame.select(hashed.alias("h")), "hashes")  # the frame is made once, not for each step of the search
    wanted = int(hashes.count() * rate)
    if wanted < 1:
        return F.lit(False), None, 0
    last, there, drawn = _last_drawn(hashes, wanted)
    if drawn == there:
        return hashed <= F.lit(last), None, 0
    # rows that share the last key are told apart by all they hold
    row = F.xxhash64(*frame.columns, F.lit(seed))
    at = hashed == F.lit(last)
    second, there, drawn = _last_drawn(frame.where(at).select(row.alias("h")), drawn)
    if drawn == there:
        return (hashed < F.lit(last)) | (at & (row <= F.lit(second))), None, 0
    return (hashed < F.lit(last)) | (at & (row < F.lit(second))), at & (row == F.lit(second)), drawn


def exact_sample(frame: DataFrame, key: str, rate: float, seed: int) -> Column:
    """Condition that holds for exactly ``int(n * rate)`` of the frame's n rows, the same ones however it is partitioned.

    It takes the rows whose key has the smallest hash; rows that share the last key are drawn by all of their columns.
    Rows alike in every column are drawn together or not at all, so some may be missing at the edge; ``sample_rows`` is
    exact for those, too.
    """
    return _draw(frame, key, rate, seed)[0]


def sample_rows(frame: DataFrame, key: str, rate: float, seed: int) -> DataFrame:
    """``int(n * rate)`` rows without replacement."""
    drawn, alike, count = _draw(frame, key, rate, seed)
    rows = frame.where(drawn)
    return rows if alike is None else rows.unionByName(frame.where(alike).limit(count))


def _overwrite(frame: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return frame.select(*[changes.get(name, F.col(name)).alias(name) for name in frame.columns])


def _copied_codes(frame: DataFrame, wanted: DataFrame, key: str, code: str, seed: int) -> DataFrame:
    """For the wanted keys the code of another row of the whole table, picked with equal chances.

    Keys and codes are numbered once; only the few numbers that were drawn are looked up.
    """
    table = staged(number_rows(frame.select(key, code), key), "codes")
    size = table.count()
    draw = Draws(F.col(key), seed)
    step = F.lit(1) + F.floor(draw.uniform("donor") * F.lit(max(size - 1, 1))).cast("long")
    drawn = table.join(wanted, key, "left_semi").select(
        F.col(key).alias("_key"), F.pmod(F.col("number") + step, F.lit(max(size, 1))).alias("_donor")
    )
    donors = table.select(F.col("number").alias("_number"), F.col(code).alias("_code"))
    return drawn.join(donors, F.col("_donor") == F.col("_number")).select("_key", "_code")


def inject_anomalies(
    frame: DataFrame,
    entity: str,
    rate: float = 0.06,
    seed: int = 42,
    kinds: Sequence[str] | None = None,
    as_of: str | None = None,
    fast: bool = False,
    chosen: Column | None = None,
) -> DataFrame:
    """Damage exactly ``int(n * rate)`` rows with one kind each, all kinds equally likely.

    ``frame`` is in landing shape and its primary key identifies a row. ``kinds`` restricts the damage, for
    example to spare foreign keys; ``fast`` takes the shorter list, which never touches keys or codes.
    ``chosen`` may be passed when the caller has drawn the rows already, as ``exact_sample`` does.
    """
    if entity not in KINDS:
        raise ValueError(f"unknown entity {entity}")
    kinds = tuple(kinds or (FAST_KINDS if fast else KINDS)[entity])
    key, code = C.PRIMARY_KEY[entity], C.BUSINESS_CODE[entity]
    draw = Draws(F.col(key), seed)
    chosen = exact_sample(frame, key, rate, seed) if chosen is None else chosen
    marked = frame.withColumn("_kind", F.when(chosen, draw.choice("kind", kinds)))

    def when(kind: str, value: Column, name: str) -> Column:
        return F.when(F.col("_kind") == kind, value).otherwise(F.col(name))

    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    later = iso_utc(now + F.make_dt_interval(days=draw.whole("days_ahead", 1, 30)))
    nothing = F.lit(None).cast("string")
    changes = {"source_timestamp": when("future_timestamp", later, "source_timestamp")}
    if entity == C.SUPPLIERS:
        changes |= {
            "on_time_delivery_rate": when("out_of_range_rate", F.lit(OUT_OF_RANGE_RATE), "on_time_delivery_rate"),
            "contact_email": when("missing_contact", nothing, "contact_email"),
            "country": when("bogus_country", F.lit(C.BOGUS_COUNTRY), "country"),
        }
        if not fast:
            changes["contact_phone"] = when("missing_contact", nothing, "contact_phone")
    else:
        stranger = record_id(draw.bits("stranger"), seed, "stranger")
        unit = FAST_WRONG_UNIT if fast else WRONG_UNIT
        changes |= {
            "unit_cost": when("negative_cost", -draw.between("cost", 1.0, 100.0), "unit_cost"),
            "uom": when("wrong_uom", F.lit(unit), "uom"),
            "default_supplier_id": when("invalid_supplier_id", stranger, "default_supplier_id"),
            "qualified_supplier_ids": when("invalid_supplier_id", F.array(stranger), "qualified_supplier_ids"),
        }
    damaged = _overwrite(marked, changes)
    if COPY_KIND[entity] not in kinds:
        return damaged.drop("_kind")

    copying = F.coalesce(F.col("_kind") == COPY_KIND[entity], F.lit(False))
    wanted = marked.where(copying).select(key)
    codes = _copied_codes(frame, wanted, key, code, seed)
    recoded = damaged.where(copying).join(codes, F.col(key) == F.col("_key"), "left")
    recoded = _overwrite(recoded, {code: F.coalesce(F.col("_code"), F.col(code))})
    return damaged.where(~copying).drop("_kind").unionByName(recoded.drop("_kind", "_key", "_code"))
