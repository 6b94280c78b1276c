"""Row rules. Each fires only when its condition is TRUE, so a NULL passes all but the MISSING_* rules."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearlot import contracts as C


class Rule(NamedTuple):
    code: str
    when: Column


def _missing(name: str) -> Column:
    return F.col(name).isNull()


def _number(name: str) -> Column:
    """Text that is no number counts as NULL, as it does once the contract's types are in place."""
    return F.col(name).try_cast("double")


def _outside(name: str, low: float, high: float) -> Column:
    return (_number(name) < low) | (_number(name) > high)


def _unknown(name: str, domain: Sequence[str]) -> Column:
    return ~F.col(name).isin(*domain)


def supplier_rules() -> list[Rule]:
    country = F.col("country")
    return [
        Rule("MISSING_SUPPLIER_ID", _missing("supplier_id")),
        Rule("MISSING_TENANT_ID", _missing("tenant_id")),
        Rule("MISSING_LEGAL_NAME", _missing("legal_name")),
        Rule("INVALID_ON_TIME_RATE", _outside("on_time_delivery_rate", 0, 100)),
        Rule("INVALID_RISK_SCORE", _outside("risk_score", 0, 100)),
        Rule("NEGATIVE_LEAD_TIME", _number("lead_time_days_avg") < 0),
        Rule("NEGATIVE_DEFECT_RATE", _number("defect_rate_ppm") < 0),
        Rule("INVALID_FINANCIAL_TIER", _unknown("financial_risk_tier", C.FINANCIAL_TIERS)),
        Rule("INVALID_STATUS", _unknown("approved_status", C.APPROVED_STATUSES)),
        Rule("INVALID_COUNTRY_CODE", (F.length(country) != 2) | (country == C.BOGUS_COUNTRY)),
    ]


def part_key_rules() -> list[Rule]:
    return [
        Rule("MISSING_PART_ID", _missing("part_id")),
        Rule("MISSING_TENANT_ID", _missing("tenant_id")),
        Rule("MISSING_PART_NUMBER", _missing("part_number")),
        Rule("MISSING_CATEGORY", _missing("category")),
    ]


def part_value_rules() -> list[Rule]:
    return [
        Rule("NEGATIVE_UNIT_COST", _number("unit_cost") < 0),
        Rule("NEGATIVE_MOQ", _number("moq") < 0),
        Rule("NEGATIVE_LEAD_TIME", _number("lead_time_days_avg") < 0),
        Rule("INVALID_CATEGORY", _unknown("category", C.PART_CATEGORIES)),
        Rule("INVALID_LIFECYCLE_STATUS", _unknown("lifecycle_status", C.LIFECYCLE_STATUSES)),
    ]


def domain_rules(entity: str, names: Sequence[str] | None = None) -> list[Rule]:
    """Optional rules ``INVALID_<COLUMN>`` from the contract's closed domains, off unless asked for."""
    domains = C.DOMAINS[entity]
    return [Rule(f"INVALID_{name.upper()}", _unknown(name, domains[name])) for name in names or domains]


def freshness_rule(as_of: Column, name: str = "source_timestamp") -> Rule:
    """Optional rule: the source time lies after ``as_of``."""
    return Rule("FUTURE_SOURCE_TIMESTAMP", F.col(name).try_cast("timestamp") > as_of)


def tag(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``dq_violations`` (codes in rule order), ``is_valid`` and ``dq_timestamp``."""
    codes = F.array_compact(F.array(*[F.when(rule.when, F.lit(rule.code)) for rule in rules]))
    return (
        frame.withColumn("dq_violations", codes)
        .withColumn("is_valid", F.size("dq_violations") == 0)
        .withColumn("dq_timestamp", F.current_timestamp())
    )


def tag_suppliers(suppliers: DataFrame, extra: Sequence[Rule] = ()) -> DataFrame:
    return tag(suppliers, [*supplier_rules(), *extra])


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where("is_valid")


def valid_ids(tagged: DataFrame, key: str = "supplier_id") -> DataFrame:
    """Keys of valid rows, the only ones parts may refer to."""
    return valid_rows(tagged).select(key)
