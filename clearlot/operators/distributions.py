"""Tests of distributions: counts against a specification, and two samples of a number against each other.

A fixed tolerance is too strict for few rows and too lax for many; a p-value says how often a table of this size that
follows the specification would depart as far.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearlot.session import staged

#: Terms of the series of the incomplete gamma function, and the argument beyond which what is left is below 1e-50.
GAMMA_TERMS, GAMMA_REACH = 1_500, 600.0
#: Terms of the series of the Kolmogorov distribution; below this argument it is 1 to 15 digits.
KOLMOGOROV_TERMS, KOLMOGOROV_LEAST = 100, 0.18
#: Ranges that distinct values are dealt to when their running counts are made.
RANGES = 64


def chi_square_tail(statistic: Column, degrees: int) -> Column:
    """The chance of a chi-square value above ``statistic``, to about 14 digits after the point."""
    shape, half = degrees / 2, statistic / 2
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(state: Column, number: Column) -> Column:
        term = state["term"] * half / (F.lit(shape) + number)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(GAMMA_TERMS)), start, step)["total"]
    below = F.exp(F.lit(shape) * F.log(half) - half - F.lit(math.lgamma(shape + 1))) * total
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - below)
    return F.when(half <= 0, F.lit(1.0)).when(half > GAMMA_REACH, F.lit(0.0)).otherwise(rest)


def chi_square(frame: DataFrame, column: str, expected: Mapping[str, float]) -> DataFrame:
    """Counts of a column's values against expected shares: rows, unexpected, statistic, degrees, p_value; one row.

    ``expected`` is scaled to a sum of 1. Rows with other values, or none, are ``unexpected``: they are not in the
    statistic, but with any of them the specification is broken and the p-value 0. Without rows nothing departs: 1.
    """
    shares = {value: share / sum(expected.values()) for value, share in expected.items() if share > 0}
    counts = [F.count_if(F.col(column) == value).alias(f"n{at}") for at, value in enumerate(shares)]
    found = frame.agg(F.count("*").alias("rows"), *counts)
    seen = sum((F.col(f"n{at}") for at in range(len(shares))), F.lit(0))
    parts = [
        F.pow(F.col(f"n{at}") - F.col("_seen") * share, F.lit(2.0)) / (F.col("_seen") * share)
        for at, share in enumerate(shares.values())
    ]
    statistic = F.when(F.col("_seen") > 0, sum(parts, F.lit(0.0))).otherwise(0.0)
    degrees = len(shares) - 1
    made = found.withColumn("_seen", seen).withColumns(
        {"statistic": statistic, "unexpected": F.col("rows") - F.col("_seen")}
    )
    tail = chi_square_tail(F.col("statistic"), degrees) if degrees else F.lit(1.0)
    return made.select(
        "rows",
        "unexpected",
        "statistic",
        F.lit(degrees).alias("degrees"),
        F.when(F.col("unexpected") > 0, 0.0).otherwise(tail).alias("p_value"),
    )


def kolmogorov_tail(distance: Column, first: Column, second: Column) -> Column:
    """The chance that two samples of one distribution, of ``first`` and ``second`` rows, lie further apart."""
    root = F.sqrt(first * second / (first + second))
    reach = (root + 0.12 + 0.11 / root) * distance
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS)),
        lambda j: F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * reach * reach),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda one, two: one + two)
    return F.when(reach < KOLMOGOROV_LEAST, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def two_samples(frame: DataFrame, number: str, first: Column) -> DataFrame:
    """Kolmogorov and Smirnov's distance between the rows where ``first`` holds and those where it does not; one row.

    first_rows, second_rows, distance, p_value. Rows without a number, or for which ``first`` is NULL, are left out; with an
    empty sample the distance is 0 and the p-value 1.

    Rows are counted by value first, so a value that a third of them has is one row. The values are dealt to tasks by
    range; each task sums up its own range on top of the ranges before it, of which there are no more than ``RANGES``.
    """
    rows = frame.select(F.col(number).cast("double").alias("value"), first.alias("first"))
    rows = rows.where(F.col("value").isNotNull() & F.col("first").isNotNull())
    counted = rows.groupBy("value").agg(F.count_if("first").alias("one"), F.count_if(~F.col("first")).alias("two"))
    dealt = counted.repartitionByRange(RANGES, "value").withColumn("range", F.spark_partition_id())
    dealt = staged(dealt, "ranges")
    totals = dealt.groupBy("range").agg(F.sum("one").alias("ones"), F.sum("two").alias("twos"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("ones").over(before), F.lit(0)).alias("ones_before"),
        F.coalesce(F.sum("twos").over(before), F.lit(0)).alias("twos_before"),
    )
    size = totals.agg(
        F.coalesce(F.sum("ones"), F.lit(0)).alias("first_rows"), F.coalesce(F.sum("twos"), F.lit(0)).alias("second_rows")
    )
    first_rows, second_rows = (size.select(name).scalar() for name in ("first_rows", "second_rows"))
    running = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ones = F.sum("one").over(running) + F.col("ones_before")
    twos = F.sum("two").over(running) + F.col("twos_before")
    gap = F.abs(F.try_divide(ones, first_rows) - F.try_divide(twos, second_rows)).alias("gap")
    told = dealt.join(F.broadcast(offsets), "range").select(gap)
    one = told.agg(F.coalesce(F.max("gap"), F.lit(0.0)).alias("distance"))
    one = one.select(first_rows.alias("first_rows"), second_rows.alias("second_rows"), "distance")
    empty = (F.col("first_rows") == 0) | (F.col("second_rows") == 0)
    tail = kolmogorov_tail(F.col("distance"), F.col("first_rows").cast("double"), F.col("second_rows").cast("double"))
    return one.withColumn("p_value", F.when(empty, 1.0).otherwise(tail))
