"""Links between members of groups, and the components that links make, without all pairs of a group.

Groups overlap and may be large. Each round lays a few pivots of every group beside all other members. Members that a
pivot has been laid beside, and members of one component, need not meet again, so a group of copies of one text is done
after one round. Pivots grow in number until no group holds two components that have not met: every pair of a group is
then verified, or known to be in one component. Groups do not need each other, so many members are taken in slices of their
keys, and the disk holds the shuffles of one slice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearlot.session import staged

#: Pivots of a group in the first round, and how many times as many each further round has.
FIRST_PIVOTS, MORE_PIVOTS = 1, 64
#: Up to so many slices, each of about so many members or more.
SLICES, MEMBERS_AT_ONCE = 8, 1_000_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("id", "root").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, root``: the least id of its component for every id in the links (``a``, ``b``) that is not itself least.

    Every id is joined to the least id beside it, first its greater neighbours, then its lesser ones, until nothing
    changes. Each step is written before the next; only counts reach the driver.
    """
    edges = staged(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("root"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("root").alias("id"), F.col("id").alias("root")))
        least = both.groupBy("id").agg(F.min("root").alias("least")).select("id", F.least("id", "least").alias("least"))
        up = (
            both.join(least, "id")
            .where(F.col("root") > F.col("id"))
            .select(F.col("root").alias("id"), F.col("least").alias("root"))
            .distinct()
        )
        lowest = up.groupBy("id").agg(F.min("root").alias("least"))
        down = up.join(lowest, "id").where(F.col("root") != F.col("least"))
        edges = staged(
            lowest.select("id", F.col("least").alias("root"))
            .unionByName(down.select(F.col("root").alias("id"), F.col("least").alias("root")))
            .distinct(),
            "edges",
        )
    return edges


def _slices(members: DataFrame) -> list[Column]:
    """Conditions on the key, one for each slice."""
    count = min(SLICES, members.count() // MEMBERS_AT_ONCE + 1)
    if count == 1:
        return [F.lit(True)]
    return [F.pmod(F.xxhash64("key"), F.lit(count)) == at for at in range(count)]


def link_groups(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    near: Callable[[DataFrame, DataFrame], Column] | None = None,
    traits: DataFrame | None = None,
) -> DataFrame:
    """The components that the true links among members of a group make, as ``components`` returns them.

    ``members`` has ``key`` and ``id``, without repeated rows, and further columns that belong to the id. ``verify``
    returns the true links among the pairs ``a, b`` that it gets. ``near`` may name a condition that linked rows of two
    frames of members fulfil. Wide columns that only ``near`` needs can come as ``traits``, one row for each ``id``.
    """
    extra = [name for name in members.columns if name not in ("key", "id")]
    members = members.withColumn("root", F.col("id"))
    links = met = roots = None
    pivots = FIRST_PIVOTS

    def described(rows: DataFrame) -> DataFrame:
        return rows if traits is None else rows.join(traits, "id")

    def beside(chosen: DataFrame, members: DataFrame) -> DataFrame:
        one, other = described(chosen).alias("one"), described(members).alias("other")
        meet = (F.col("one.key") == F.col("other.key")) & (F.col("one.root") != F.col("other.root"))
        meet &= F.col("one.id") != F.col("other.id")
        if near is not None:
            meet &= near(one, other)
        return (
            other.join(one, meet)
            .select(
                F.least(F.col("one.id"), F.col("other.id")).alias("a"),
                F.greatest(F.col("one.id"), F.col("other.id")).alias("b"),
            )
            .distinct()
        )

    def still_open(chosen: DataFrame, members: DataFrame) -> DataFrame:
        rest = (
            members.join(chosen.select("key", "id"), ["key", "id"], "left_anti")
            .drop("root")
            .join(roots.withColumnRenamed("root", "found"), "id", "left")
            .select("key", "id", *extra, F.coalesce("found", "id").alias("root"))
        )
        open_keys = (
            rest.groupBy("key")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where(F.col("low") < F.col("high"))
            .select("key")
        )
        return rest.join(open_keys, "key", "left_semi")

    def in_slices(step: Callable[[DataFrame, DataFrame], DataFrame], label: str) -> DataFrame:
        made = [staged(step(chosen, members.where(part)), label) for part, chosen in zip(parts, pivot_rows, strict=True)]
        return reduce(DataFrame.unionByName, made)

    while True:
        parts = _slices(members)
        place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        pivot_rows = [
            staged(members.where(part).withColumn("place", place).where(F.col("place") <= pivots).drop("place"), "pivots")
            for part in parts
        ]
        pairs = in_slices(beside, "pairs")
        if met is not None:
            pairs = pairs.join(met, ["a", "b"], "left_anti")
        if len(parts) > 1 or met is not None:
            pairs = staged(pairs.distinct(), "pairs")
        found = verify(pairs)
        found = staged(found, "links")
        met = pairs if met is None else met.unionByName(pairs)
        if links is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links)
        members = in_slices(still_open, "members")
        if members.isEmpty():
            return roots
        pivots *= MORE_PIVOTS
