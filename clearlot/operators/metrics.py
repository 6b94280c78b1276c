"""Counts, rates, distributions and profile checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot.functions.lookups import risk_tier


def _rate(part: Column, whole: Column) -> Column:
    """Percentage, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def validation_metrics(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, valid rows and pass rate, in one pass; per group when ``by`` is given."""
    counted = tagged.groupBy(*by).agg(F.count("*").alias("total"), F.count_if("is_valid").alias("valid"))
    return with_pass_rate(counted)


def with_pass_rate(counted: DataFrame) -> DataFrame:
    """Add the pass rate to counts of ``total`` and ``valid`` rows."""
    return counted.withColumn("pass_rate", _rate(F.col("valid"), F.col("total")))


def overall_pass_rate(*metrics: DataFrame) -> DataFrame:
    """Totals over several metric frames; 0 when all are empty."""
    stacked = metrics[0].select("total", "valid")
    for other in metrics[1:]:
        stacked = stacked.unionByName(other.select("total", "valid"))
    summed = stacked.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("valid"), F.lit(0)).alias("valid")
    )
    return summed.withColumn("pass_rate", _rate(F.col("valid"), F.col("total")))


def quality_gate(metrics: DataFrame, threshold: float = 99.0) -> DataFrame:
    """Add ``passed``: whether the pass rate reaches the threshold."""
    return metrics.withColumn("passed", F.col("pass_rate") >= F.lit(threshold))


def violation_counts(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per violation code, most frequent codes not singled out: a row counts once for each of its codes."""
    return (
        tagged.select(*by, F.explode("dq_violations").alias("violation"))
        .groupBy(*by, "violation")
        .agg(F.count("*").alias("rows"))
    )


def violation_profile(tagged: DataFrame) -> DataFrame:
    """Rows per combination of codes, comma-joined in rule order; the empty text stands for valid rows."""
    return tagged.groupBy(F.array_join("dq_violations", ",").alias("violations")).agg(F.count("*").alias("rows"))


def shares(frame: DataFrame, column: str) -> DataFrame:
    """Rows and share of the total for each value of a column."""
    counts = frame.groupBy(column).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total)


def share_against_spec(
    frame: DataFrame, column: str, expected: Mapping[str, float], tolerance: float = 0.05
) -> DataFrame:
    """Shares next to the expected ones. Values outside the specification count as expected 0."""
    spec = F.create_map(*[F.lit(part) for pair in expected.items() for part in pair])
    target = F.coalesce(F.try_element_at(spec, F.col(column)), F.lit(0.0))
    return (
        shares(frame, column)
        .withColumn("expected", target)
        .withColumn("within", F.abs(F.col("share") - F.col("expected")) <= F.lit(tolerance))
    )


def top_values(frame: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts are ordered by value."""
    counts = frame.groupBy(column).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), F.col(column)).limit(k)


def list_sizes(frame: DataFrame, items: Column) -> DataFrame:
    """Rows and share per list length."""
    return shares(frame.select(F.size(items).alias("items")), "items")


def list_size_bounds(frame: DataFrame, items: Column) -> DataFrame:
    return frame.select(F.size(items).alias("items")).agg(
        F.min("items").alias("smallest"), F.max("items").alias("largest")
    )


def correlation(frame: DataFrame, left: str, right: str) -> DataFrame:
    return frame.agg(F.corr(left, right).alias("correlation"))


def average_by(frame: DataFrame, group: str, value: str) -> DataFrame:
    return frame.groupBy(group).agg(F.avg(value).alias("average"))


def duplicate_surplus(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key column: rows, different values and how many rows are too many.

    One column at a time, so each count reduces its own rows before the shuffle.
    """
    parts = []
    for key in keys:
        per_value = frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        parts.append(
            per_value.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_values")).select(
                F.lit(key).alias("key"),
                "rows",
                "distinct_values",
                (F.col("rows") - F.col("distinct_values")).alias("surplus"),
            )
        )
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def approximate_surplus(frame: DataFrame, keys: Sequence[str], error: float = 0.02) -> DataFrame:
    """The same from sketches: one pass for all keys and no shuffle of values, within the relative error."""
    counts = [
        F.struct(
            F.lit(key).alias("key"),
            F.count(key).alias("rows"),
            F.approx_count_distinct(key, error).alias("distinct_values"),
        )
        for key in keys
    ]
    rows = frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    return rows.withColumn("surplus", F.greatest(F.col("rows") - F.col("distinct_values"), F.lit(0)))


def range_summary(frame: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """One row per column: smallest and largest value and how many rows lie outside the bounds."""
    measures = []
    for name, (low, high) in bounds.items():
        value = F.col(name).try_cast("double")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < low)
        if high is not None:
            outside = outside | (value > high)
        measures.append(
            F.struct(
                F.lit(name).alias("column"),
                F.min(value).alias("smallest"),
                F.max(value).alias("largest"),
                F.count_if(outside).alias("outside"),
            )
        )
    rows = frame.agg(F.array(*measures).alias("measures")).select(F.inline("measures"))
    return rows.withColumn("in_range", F.col("outside") == 0)


def anomaly_counts(frame: DataFrame, kinds: Mapping[str, Column]) -> DataFrame:
    """One row per anomaly kind with the rows that show it."""
    counts = [F.struct(F.lit(kind).alias("kind"), F.count_if(test).alias("rows")) for kind, test in kinds.items()]
    return frame.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def supplier_anomalies(as_of: Column) -> dict[str, Column]:
    return {
        "out_of_range_rate": F.col("on_time_delivery_rate").try_cast("double") > 100,
        "missing_contact": F.col("contact_email").isNull(),
        "bogus_country": F.col("country") == "XX",
        "future_timestamp": F.col("source_timestamp").try_cast("timestamp") > as_of,
    }


def part_anomalies(as_of: Column, units: Sequence[str]) -> dict[str, Column]:
    return {
        "negative_cost": F.col("unit_cost").try_cast("double") < 0,
        "wrong_uom": ~F.col("uom").isin(*units),
        "future_timestamp": F.col("source_timestamp").try_cast("timestamp") > as_of,
    }


def tier_disagreements(suppliers: DataFrame) -> DataFrame:
    """Rows, and rows whose stated tier is not the one their score gives."""
    expected = risk_tier(F.col("risk_score"))
    return suppliers.agg(
        F.count("*").alias("rows"), F.count_if(F.col("financial_risk_tier") != expected).alias("disagreeing")
    )
