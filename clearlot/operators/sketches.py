"""Profiles that merge: distinct counts, quantiles and frequent values of any range of tenants and dates.

A profile of one tenant and date is a row of sketches, made in one pass with partial aggregation and stored beside the data.
What is asked of many dates is then answered from these rows, without another look at the data. Sketches have a fixed
largest size, whatever they have seen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot.sources.tables import overwrite_partitions

#: Logarithm of the registers of a distinct count; values that a frequency sketch tracks; size of a quantile sketch.
LOG_REGISTERS, TRACKED_VALUES, QUANTILE_SIZE = 14, 1_000, 400
#: Three standard errors of a distinct count, as a share of it.
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(1 << LOG_REGISTERS)
#: How far the rank of a quantile may be off, as a share of the rows, with 99 percent confidence.
RANK_ERROR = 2 * 2.296 / QUANTILE_SIZE**0.9021


@dataclass(frozen=True)
class Wanted:
    """What a profile is to tell: distinct values and duplicates, quantiles of numbers, frequencies of values."""

    distinct: Sequence[str] = ()
    numbers: Sequence[str] = ()
    values: Sequence[str] = ()


def sketch_profile(frame: DataFrame, by: Sequence[str], wanted: Wanted) -> DataFrame:
    """One row of sketches for each group, in one pass: ``rows``, and for each column its sketch and its filled rows.

    NULLs count as rows only. Numbers that are not finite are left out of quantiles.
    """
    made: list[Column] = [F.count("*").alias("rows")]
    for name in wanted.distinct:
        text = F.concat(F.lit("="), F.col(name).cast("string"))  # the sketch would pass over an empty text
        made += [F.hll_sketch_agg(text, LOG_REGISTERS).alias(f"distinct_{name}"), F.count(name).alias(f"filled_{name}")]
    for name in wanted.numbers:
        number = F.col(name).try_cast("double")
        finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
        made.append(F.kll_sketch_agg_double(finite, QUANTILE_SIZE).alias(f"numbers_{name}"))
    for name in wanted.values:
        counted = F.call_function("approx_top_k_accumulate", F.col(name).cast("string"), F.lit(TRACKED_VALUES))
        made.append(counted.alias(f"values_{name}"))
    return frame.groupBy(*by).agg(*made)


def merge_profiles(profiles: DataFrame, wanted: Wanted, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of larger groups, or of everything, from profiles of smaller ones."""
    made: list[Column] = [F.sum("rows").alias("rows")]
    for name in wanted.distinct:
        sketch = F.hll_union_agg(f"distinct_{name}").alias(f"distinct_{name}")
        made += [sketch, F.sum(f"filled_{name}").alias(f"filled_{name}")]
    made += [F.kll_merge_agg_double(f"numbers_{name}").alias(f"numbers_{name}") for name in wanted.numbers]
    for name in wanted.values:
        combined = F.call_function("approx_top_k_combine", F.col(f"values_{name}"), F.lit(TRACKED_VALUES))
        made.append(combined.alias(f"values_{name}"))
    return profiles.groupBy(*by).agg(*made)


def distinct_estimate(name: str) -> Column:
    """Distinct values of a column of a profile, off by at most ``DISTINCT_ERROR`` of them in 99.7 of 100 cases.

    A sketch joined with itself is estimated from its registers alone, so merged profiles and one pass agree exactly.
    """
    sketch = F.col(f"distinct_{name}")
    return F.coalesce(F.hll_sketch_estimate(F.hll_union(sketch, sketch)), F.lit(0)).cast("long")


def surplus_estimate(name: str) -> Column:
    """Filled rows less distinct values: how many rows repeat a value."""
    return F.greatest(F.col(f"filled_{name}") - distinct_estimate(name), F.lit(0).cast("long"))


def quantile_estimates(name: str, ranks: Sequence[float]) -> Column:
    """The values at some ranks between 0 and 1, each off by at most ``RANK_ERROR`` in rank; NULL without numbers."""
    sketch = F.col(f"numbers_{name}")
    empty = sketch.isNull() | (F.kll_sketch_get_n_double(sketch) == 0)
    found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank))) for rank in ranks])
    return F.when(~empty, found)


def frequent_values(profiles: DataFrame, name: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent values with their rows; exact while a column has fewer values than three quarters of
    ``TRACKED_VALUES``."""
    found = F.call_function("approx_top_k_estimate", F.col(f"values_{name}"), F.lit(k))
    return profiles.select(*by, F.inline(found)).withColumnsRenamed({"item": name, "count": "rows"})


def store_profiles(profiles: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """Keep profiles in a folder; those of a partition that is written again are replaced."""
    overwrite_partitions(profiles, path, partitions)
