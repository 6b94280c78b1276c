"""Foreign keys from parts to valid suppliers, single and list-valued."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearlot.functions.lists import as_list, is_array
from clearlot.operators.members import DEFAULT_LIMITS, Limits, Measure, flag_members, measure, orphans
from clearlot.operators.rules import Rule, part_key_rules, part_value_rules, tag
from clearlot.session import staged


def list_members(frame: DataFrame, name: str) -> DataFrame:
    """One row per list element: the list column as stored, and ``member``."""
    return frame.where(F.col(name).isNotNull()).select(name, F.explode(as_list(frame, name)).alias("member"))


def lists_with_orphans(
    frame: DataFrame, name: str, ids: DataFrame, limits: Limits = DEFAULT_LIMITS, size: Measure | None = None
) -> DataFrame:
    """The distinct list values of which at least one element is not among ``ids``.

    The stored value itself serves as the key, so rows with missing or repeated primary keys do no harm. When the ids are
    too many to be broadcast, each distinct list is taken apart once; else rows are, as that needs no shuffle.
    """
    size = size or measure(ids)
    lists = frame if size.fits(limits) else frame.select(name).distinct()
    checked = flag_members(list_members(lists, name), "member", ids, "_known", limits, size)
    return checked.where("NOT _known").select(name).distinct()


def check_references(
    parts: DataFrame,
    ids: DataFrame,
    limits: Limits = DEFAULT_LIMITS,
    size: Measure | None = None,
    stage: bool = True,
) -> DataFrame:
    """Add ``_default_known`` and ``_list_broken``; no row is lost or repeated.

    The broken lists are written once to the shared folder; without ``stage`` they are worked out twice, once
    for counting and once for joining.
    """
    size = size or measure(ids)
    broken = lists_with_orphans(parts, "qualified_supplier_ids", ids, limits, size)
    if stage:
        broken = staged(broken, "broken-lists")
    flagged = flag_members(parts, "default_supplier_id", ids, "_default_known", limits, size)
    return flag_members(flagged, "qualified_supplier_ids", broken, "_list_broken", limits)


def tag_parts(
    parts: DataFrame,
    ids: DataFrame,
    strict_text: bool = False,
    extra: Sequence[Rule] = (),
    limits: Limits = DEFAULT_LIMITS,
    size: Measure | None = None,
    stage: bool = True,
) -> DataFrame:
    """Tag parts against the ids of valid suppliers.

    An array-typed list column is read as a list. With ``strict_text`` every non-empty array is reported as
    INVALID_QUALIFIED_SUPPLIER_FORMAT instead, because the landing format wants text.
    """
    default = F.col("default_supplier_id")
    absent = default.isNull() | (default == "")
    if strict_text and is_array(parts, "qualified_supplier_ids"):
        checked = flag_members(parts, "default_supplier_id", ids, "_default_known", limits, size)
        list_rule = Rule("INVALID_QUALIFIED_SUPPLIER_FORMAT", F.size("qualified_supplier_ids") > 0)
    else:
        checked = check_references(parts, ids, limits, size, stage)
        list_rule = Rule("ORPHAN_QUALIFIED_SUPPLIER", F.col("_list_broken"))
    reference_rules = [
        Rule("MISSING_DEFAULT_SUPPLIER", absent),
        Rule("ORPHAN_DEFAULT_SUPPLIER", ~absent & ~F.col("_default_known")),
        list_rule,
    ]
    tagged = tag(checked, [*part_key_rules(), *reference_rules, *part_value_rules(), *extra])
    return tagged.drop("_default_known", "_list_broken")


def orphan_defaults(parts: DataFrame, ids: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Parts that name a default supplier which is not among ``ids``."""
    named = parts.where((F.col("default_supplier_id") != ""))
    return orphans(named, "default_supplier_id", ids, limits)


def orphan_list_members(parts: DataFrame, ids: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``part_id`` and ``member`` for every list element that is not among ``ids``."""
    exploded = parts.select("part_id", F.explode(as_list(parts, "qualified_supplier_ids")).alias("member"))
    return orphans(exploded, "member", ids, limits)


def default_in_list(parts: DataFrame) -> DataFrame:
    """Add ``default_in_list``: whether the default supplier is one of the qualified ones."""
    return parts.withColumn(
        "default_in_list", F.array_contains(as_list(parts, "qualified_supplier_ids"), F.col("default_supplier_id"))
    )


def accept_children(children: DataFrame, key: str, parents: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Declared foreign key as a gate: the rows a database would accept. A NULL key is accepted."""
    flagged = flag_members(children, key, parents, "_known", limits)
    return flagged.where(F.col("_known") | F.col(key).isNull()).drop("_known")
