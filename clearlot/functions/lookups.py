"""Small lookups and scores shared by cleaning, checking and synthesis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region and currency of the countries in use.
REGION_OF = {
    "US": "AMERICAS", "MX": "AMERICAS",
    "CN": "APAC", "JP": "APAC", "KR": "APAC", "IN": "APAC", "VN": "APAC",
    "DE": "EMEA", "PL": "EMEA",
}
CURRENCY_OF = {
    "US": "USD", "CN": "CNY", "DE": "EUR", "MX": "MXN",
    "IN": "INR", "VN": "VND", "PL": "PLN", "JP": "JPY", "KR": "KRW",
}
OTHER_REGION = "OTHER"
OTHER_CURRENCY = "USD"

# Lower bounds of the MEDIUM and HIGH financial risk tiers.
MEDIUM_FROM = 35
HIGH_FROM = 60


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    pairs = ", ".join(f"'{name}', '{value}'" for name, value in table.items())
    return F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), key), F.lit(default))


def derive_region(country: Column) -> Column:
    return _lookup(country, REGION_OF, OTHER_REGION)


def derive_currency(country: Column) -> Column:
    return _lookup(country, CURRENCY_OF, OTHER_CURRENCY)


def risk_tier(score: Column, negative_is_low: bool = False) -> Column:
    """Financial tier of a score. A negative score is HIGH, or LOW with ``negative_is_low``."""
    low = score < MEDIUM_FROM
    if not negative_is_low:
        low = low & (score >= 0)
    medium = (score >= MEDIUM_FROM) & (score < HIGH_FROM)
    return F.when(low, "LOW").when(medium, "MEDIUM").otherwise("HIGH")


def base_risk(on_time_rate: Column, noise: Column | None = None) -> Column:
    """Risk grows with missed deliveries: ``100 - rate`` plus noise, kept within 0..100, two decimals."""
    missed = F.greatest(F.lit(0.0), F.lit(100.0) - on_time_rate)
    noisy = missed if noise is None else missed + noise
    return F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), noisy)), 2)


def is_record_id(value: Column) -> Column:
    """26 characters of Crockford base 32."""
    return value.rlike("^[0-9A-HJKMNP-TV-Z]{26}$")


def utc_text(moment: Column, pattern: str) -> Column:
    """A timestamp as text in UTC, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), pattern)


def iso_utc(moment: Column) -> Column:
    """A timestamp as landing files write it."""
    return utc_text(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
