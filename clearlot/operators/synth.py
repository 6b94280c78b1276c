"""Seeded test tables: suppliers and parts in landing shape, one row per given id.

Every value is a function of (id, seed), so a table can be made by any number of tasks, in any order, and
parts can name suppliers by rebuilding their ids instead of looking them up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions.draws import Draws, record_id
from clearlot.functions.lookups import base_risk, derive_currency, derive_region, iso_utc, risk_tier

FULL = "full"
FAST = "fast"

# Distributions of the synthetic tables.
COUNTRY_WEIGHTS = {"CN": 22, "US": 18, "DE": 10, "MX": 10, "IN": 10, "VN": 8, "PL": 6, "JP": 8, "KR": 8}
CERTIFICATION_WEIGHTS = [0.7, 0.3, 0.1, 0.2]
STATUS_WEIGHTS = {"APPROVED": 0.80, "PENDING": 0.15, "SUSPENDED": 0.04, "BLACKLISTED": 0.01}
INCOTERM_WEIGHTS = [0.4, 0.3, 0.2, 0.1]
CATEGORY_WEIGHTS = {"ELECTRICAL": 0.35, "MECHANICAL": 0.35, "RAW_MATERIAL": 0.20, "OTHER": 0.10}
CATEGORY_LEAD_TIMES = {"ELECTRICAL": (32, 8), "MECHANICAL": (24, 6), "RAW_MATERIAL": (14, 4), "OTHER": (20, 5)}
LIFECYCLE_WEIGHTS = {"ACTIVE": 0.75, "NEW": 0.10, "NRND": 0.10, "EOL": 0.05}
LIST_SIZE_WEIGHTS = {1: 0.6, 2: 0.3, 3: 0.1}
FLAG_COUNT_WEIGHTS = {0: 0.4, 1: 0.5, 2: 0.1}
GRADE_WEIGHTS = {"A": 0.6, "B": 0.3, "C": 0.1}
UNIT_WEIGHTS = {"EA": 0.7, "KG": 0.2, "M": 0.1}
ORDER_QUANTITIES = [1, 10, 50, 100, 500]

# Words for invented names; any words would do.
_NAME_HEADS = ["Alder", "Basalt", "Cobalt", "Dune", "Ember", "Fjord", "Granite", "Harbor", "Indigo", "Juniper"]
_NAME_TAILS = ["Castings", "Components", "Dynamics", "Fasteners", "Foundry", "Instruments", "Metals", "Polymers"]
_NAME_FORMS = ["Ltd", "Inc", "GmbH", "Group", "Co"]
_STREETS = ["Mill Lane", "Dock Road", "Station Street", "Quarry Way", "Canal Walk", "Forge Avenue"]
_CITIES = ["Northhaven", "Eastbrook", "Millford", "Stonebridge", "Lakeside", "Fairport", "Greenfield"]
_US_STATES = ["CA", "TX", "OH", "NY", "WA", "IL", "MI", "GA"]
_PART_WORDS = ["sealed", "rotary", "bearing", "housing", "bracket", "valve", "sensor", "coil", "plate", "spring"]


def ids_from_range(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(rows)


def spread(ids: DataFrame) -> DataFrame:
    """Ids dealt to many tasks: a few bytes of each id are one split of a file, but become a wide row."""
    return ids.repartition(*ids.columns)


def _pick(draw: Draws, purpose: str, weights: dict) -> Column:
    return draw.choice(purpose, list(weights), list(weights.values()))


def _company(draw: Draws, purpose: str) -> Column:
    words = [_NAME_HEADS, _NAME_TAILS, _NAME_FORMS]
    return F.concat_ws(" ", *[draw.choice(f"{purpose}.{at}", options) for at, options in enumerate(words)])


def _tokens(draw: Draws, purpose: str, prefix: str, length: int, count: Column) -> Column:
    """``count`` (0 to 2) different tokens."""
    both = F.array(*[F.concat(F.lit(prefix), draw.token(f"{purpose}.{at}", length)) for at in (1, 2)])
    return F.slice(both, F.lit(1), count)


def _source_time(draw: Draws, as_of: Column) -> Column:
    return iso_utc(as_of - F.make_dt_interval(days=draw.whole("source_age", 0, 30)))


def _moment(as_of: str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def synth_suppliers(
    ids: DataFrame, seed: int = 42, tenant: str = "tenant_a", as_of: str | None = None, variant: str = FULL
) -> DataFrame:
    """Suppliers for the rows of ``ids`` (one bigint column). ``as_of`` fixes the clock.

    ``variant="fast"`` takes the simpler distributions: narrow risk noise, equal weights for lists and
    incoterms, at most one contract.
    """
    (name,) = ids.columns
    key = F.col(name)
    draw = Draws(key, seed)
    fast = variant == FAST
    now = _moment(as_of)

    rate = draw.clipped("on_time", 93, 5, 60, 100)
    noise = draw.normal("risk_noise", 5, 3) if fast else draw.normal("risk_noise", 0, 8)
    if fast:
        list_size = draw.whole("certification_count", 1, 3)
        flag_count = draw.whole("flag_count", 0, 2)
        contract_count = F.when(draw.chance("contract_count", 0.5), 1).otherwise(0)
    else:
        list_size = _pick(draw, "certification_count", LIST_SIZE_WEIGHTS)
        flag_count = _pick(draw, "flag_count", FLAG_COUNT_WEIGHTS)
        contract_count = draw.whole("contract_count", 0, 2)

    first = ids.select(
        key,
        rate.alias("_rate"),
        base_risk(rate, noise).alias("_risk"),
        _pick(draw, "country", COUNTRY_WEIGHTS).alias("_country"),
        _company(draw, "legal_name").alias("_legal_name"),
        list_size.alias("_certification_count"),
        flag_count.alias("_flag_count"),
        contract_count.alias("_contract_count"),
    )
    country, legal_name = F.col("_country"), F.col("_legal_name")
    other_name = F.concat(legal_name, F.lit(" Corp")) if fast else _company(draw, "dba_name")
    street = F.concat_ws(" ", draw.whole("house", 1, 9999).cast("string"), draw.choice("street", _STREETS))
    second_line = F.lit(None).cast("string")
    if not fast:
        unit = F.concat(F.lit("Unit "), draw.whole("unit", 1, 99).cast("string"))
        second_line = F.when(draw.chance("has_unit", 0.2), unit)
    state = F.lit("CA") if fast else draw.choice("state", _US_STATES)
    host = F.lower(F.replace(legal_name, F.lit(" "), F.lit("")))
    incoterm_weights = None if fast else INCOTERM_WEIGHTS
    certification_weights = None if fast else CERTIFICATION_WEIGHTS
    values = {
        "supplier_id": record_id(key, seed, "supplier"),
        "supplier_code": F.concat(F.lit("S"), draw.whole("code", 100000, 999999).cast("string")),
        "tenant_id": F.lit(tenant),
        "legal_name": legal_name,
        "dba_name": F.when(draw.chance("has_dba", 0.3), other_name),
        "country": country,
        "region": derive_region(country),
        "address_line1": street,
        "address_line2": second_line,
        "city": draw.choice("city", _CITIES),
        "state": F.when(country == "US", state),
        "postal_code": draw.whole("postal_code", 10000, 99999).cast("string"),
        "contact_email": F.concat(F.lit("contact"), key.cast("string"), F.lit("@"), host, F.lit(".com")),
        "contact_phone": F.concat(F.lit("+1-555-"), draw.whole("phone", 1000000, 9999999).cast("string")),
        "preferred_currency": derive_currency(country),
        "incoterms": draw.choice("incoterms", list(C.INCOTERMS), incoterm_weights),
        "lead_time_days_avg": draw.clipped("lead_avg", 21, 6, 3, 90).cast("int"),
        "lead_time_days_p95": draw.clipped("lead_p95", 35, 10, 7, 180).cast("int"),
        "on_time_delivery_rate": F.round("_rate", 2),
        "defect_rate_ppm": F.abs(draw.normal("defects", 250, 180)).cast("int"),
        "capacity_units_per_week": F.abs(draw.normal("capacity", 5000, 3000)).cast("int") + F.lit(100),
        "risk_score": F.col("_risk"),
        "financial_risk_tier": risk_tier(F.col("_risk"), negative_is_low=fast),
        "certifications": draw.subset(
            "certifications", list(C.CERTIFICATIONS), F.col("_certification_count"), certification_weights
        ),
        "compliance_flags": draw.subset("flags", list(C.COMPLIANCE_FLAGS), F.col("_flag_count")),
        "approved_status": _pick(draw, "status", STATUS_WEIGHTS),
        "contracts": _tokens(draw, "contracts", "CONTRACT_", 8, F.col("_contract_count")),
        "terms_version": F.concat_ws(
            ".", draw.whole("terms.major", 1, 5).cast("string"), draw.whole("terms.minor", 0, 9).cast("string")
        ),
        "geo_coords": F.struct(
            F.round(draw.between("lat", -90, 90), 6).alias("lat"),
            F.round(draw.between("lon", -180, 180), 6).alias("lon"),
        ),
        "data_source": F.lit(C.DATA_SOURCE),
        "source_timestamp": _source_time(draw, now),
        "ingestion_timestamp": iso_utc(now),
        "schema_version": F.lit(C.SCHEMA_VERSION),
    }
    return first.select(*[value.alias(column) for column, value in values.items()])


def number_rows(frame: DataFrame, key: str, buckets: int = 65_536) -> DataFrame:
    """Add ``number``: 0..n-1, the same however the rows are partitioned. ``key`` identifies a row.

    Rows are counted within hash buckets and the buckets are offset by the sizes of those before, so no
    window ever holds more than one bucket of about n/65536 rows, or the 65536 bucket sizes.
    """
    bucketed = frame.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_at", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("number", F.col("_offset") + F.col("_at") - 1)
        .drop("_bucket", "_offset", "_at")
    )


def _different_numbers(draw: Draws, count: Column, parents: int) -> Column:
    """``count`` (1 to 3) different numbers below ``parents``, each combination equally likely.

    The second draw skips the first number and the third skips both, in ascending order.
    """
    size = F.lit(parents)

    def below(purpose: str, bound: Column) -> Column:
        return F.floor(draw.uniform(purpose) * bound).cast("long")

    one = below("parent.1", size)
    two = below("parent.2", size - 1)
    two = two + (two >= one).cast("long")
    low, high = F.least(one, two), F.greatest(one, two)
    three = below("parent.3", size - 2)
    three = three + (three >= low).cast("long")
    three = three + (three >= high).cast("long")
    return F.slice(F.array(one, two, three), F.lit(1), F.least(count, size.cast("int")))


def _part_references(
    ids: DataFrame, draw: Draws, seed: int, parents: DataFrame | int, list_size: Column
) -> DataFrame:
    """``id`` with ``_qualified``: ids of one to three different suppliers."""
    (name,) = ids.columns
    if isinstance(parents, int):
        if parents < 1:
            raise ValueError("parts need at least one supplier to refer to")
        numbers = _different_numbers(draw, list_size, parents)
        rebuilt = F.transform(numbers, lambda number: record_id(number, seed, "supplier"))
        return ids.select(name, rebuilt.alias("_qualified"))
    (parent_key,) = parents.columns
    different = parents.where(F.col(parent_key).isNotNull()).distinct()
    rows = different.count()
    if rows < 1:
        raise ValueError("parts need at least one supplier to refer to")
    numbered = number_rows(different, parent_key)
    wanted = ids.select(name, F.posexplode(_different_numbers(draw, list_size, rows)).alias("_at", "number"))
    found = wanted.join(numbered, "number").groupBy(name)
    # At most three elements per part, so the list is small whatever the table's size.
    return found.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_at", F.col(parent_key).alias("_id")))), lambda item: item["_id"]
        ).alias("_qualified")
    )


def synth_parts(
    ids: DataFrame,
    parents: DataFrame | int,
    seed: int = 42,
    tenant: str = "tenant_a",
    as_of: str | None = None,
    variant: str = FULL,
) -> DataFrame:
    """Parts for the rows of ``ids`` that refer to existing suppliers.

    ``parents`` is either the number of suppliers synthesised from ``spark.range`` with the same seed, whose
    ids are then rebuilt without a join, or a one-column frame of supplier ids.
    """
    (name,) = ids.columns
    key = F.col(name)
    draw = Draws(key, seed)
    fast = variant == FAST
    now = _moment(as_of)
    list_size = draw.whole("list_size", 1, 3) if fast else _pick(draw, "list_size", LIST_SIZE_WEIGHTS)
    flag_count = draw.whole("flag_count", 0, 2) if fast else _pick(draw, "flag_count", FLAG_COUNT_WEIGHTS)
    bom_count = F.when(draw.chance("bom_count", 0.3), 1).otherwise(0) if fast else draw.whole("bom_count", 0, 2)
    if fast:
        description = F.concat(F.lit("Part component "), (key + 1).cast("string"), F.lit(" for manufacturing"))
    else:
        description = F.concat_ws(" ", *[draw.choice(f"word.{at}", _PART_WORDS) for at in range(5)])

    category = _pick(draw, "category", CATEGORY_WEIGHTS)
    first = _part_references(ids, draw, seed, parents, list_size).select(
        key,
        "_qualified",
        category.alias("_category"),
        flag_count.alias("_flag_count"),
        bom_count.alias("_bom_count"),
    )

    def by_category(position: int) -> Column:
        chosen = F.lit(float(CATEGORY_LEAD_TIMES["OTHER"][position]))
        for option in ("ELECTRICAL", "MECHANICAL", "RAW_MATERIAL"):
            mean = F.lit(float(CATEGORY_LEAD_TIMES[option][position]))
            chosen = F.when(F.col("_category") == option, mean).otherwise(chosen)
        return chosen

    mean, deviation = by_category(0), by_category(1)
    values = {
        "part_id": record_id(key, seed, "part"),
        "tenant_id": F.lit(tenant),
        "part_number": F.concat(F.lit("P-"), draw.whole("number", 100000, 999999).cast("string")),
        "description": description,
        "category": F.col("_category"),
        "lifecycle_status": _pick(draw, "lifecycle", LIFECYCLE_WEIGHTS),
        "uom": _pick(draw, "uom", UNIT_WEIGHTS),
        "spec_hash": F.concat(F.lit("SPEC_"), draw.token("spec", 16)),
        "bom_compatibility": _tokens(draw, "bom", "BOM_", 8, F.col("_bom_count")),
        "default_supplier_id": F.element_at("_qualified", 1),
        "qualified_supplier_ids": F.col("_qualified"),
        "unit_cost": F.round(F.exp(draw.normal("cost", 3.0, 0.8)), 2),
        "moq": draw.choice("moq", ORDER_QUANTITIES).cast("int"),
        "lead_time_days_avg": draw.clipped("lead_avg", mean, deviation, 2, 200).cast("int"),
        "lead_time_days_p95": draw.clipped("lead_p95", mean + 8, deviation, 5, 250).cast("int"),
        "quality_grade": _pick(draw, "grade", GRADE_WEIGHTS),
        "compliance_flags": draw.subset("flags", list(C.COMPLIANCE_FLAGS), F.col("_flag_count")),
        "hazard_class": F.when(draw.chance("hazard", 0.1), draw.choice("hazard_class", list(C.HAZARD_CLASSES))),
        "last_price_change": F.date_format(
            now - F.make_dt_interval(days=draw.whole("price_age", 30, 365)), "yyyy-MM-dd"
        ),
        "data_source": F.lit(C.DATA_SOURCE),
        "source_timestamp": _source_time(draw, now),
        "ingestion_timestamp": iso_utc(now),
        "schema_version": F.lit(C.SCHEMA_VERSION),
    }
    return first.select(*[value.alias(column) for column, value in values.items()])
