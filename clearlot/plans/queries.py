"""Every operator as a query over the given tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.functions import lists as L
from clearlot.functions.lookups import base_risk, derive_currency, derive_region, risk_tier, utc_text
from clearlot.operators import (
    checks,
    clean,
    curate,
    dirt,
    distributions,
    merge,
    metrics,
    references,
    rules,
    sketches,
    synth,
)
from clearlot.operators.members import flag_members as members_flag
from clearlot.operators.members import Limits, measure, members_only
from clearlot.plans import curation, dataset
from clearlot.plans.tables import accounts, landed_parts, landed_suppliers, parts, suppliers, table
from clearlot.session import fresh_folder, staged
from clearlot.sources import exports, landing, tables
from clearlot.streaming.curation import curate_new_files
from clearlot.streaming.incremental import load_new_files, watch_folder
from clearlot.streaming.latest import latest_rows, load_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _codes() -> Column:
    return F.array_join("dq_violations", ",").alias("violations")


def _rounded(frame: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({name: F.round(F.col(name), digits) for name in names})


def _tagged_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return rules.tag_suppliers(suppliers(spark, folder))


def _tagged_parts(spark: SparkSession, folder: str) -> DataFrame:
    return references.tag_parts(parts(spark, folder), _valid_ids(spark, folder))


def _valid_ids(spark: SparkSession, folder: str) -> DataFrame:
    return rules.valid_ids(_tagged_suppliers(spark, folder))


# ---------------------------------------------------------------- tagging and rates


@query
def supplier_tagged(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged_suppliers(spark, folder).select("supplier_id", "tenant_id", _codes(), "is_valid")


@query
def supplier_violation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.violation_counts(_tagged_suppliers(spark, folder))


@query
def supplier_violation_profile(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.violation_profile(_tagged_suppliers(spark, folder))


@query
def supplier_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.validation_metrics(_tagged_suppliers(spark, folder)), "pass_rate")


@query
def part_tagged(spark: SparkSession, folder: str) -> DataFrame:
    return _tagged_parts(spark, folder).select("part_id", "tenant_id", _codes(), "is_valid")


@query
def part_violation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.violation_counts(_tagged_parts(spark, folder))


@query
def part_violation_profile(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.violation_profile(_tagged_parts(spark, folder))


@query
def part_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.validation_metrics(_tagged_parts(spark, folder)), "pass_rate")


@query
def overall_pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    both = [
        metrics.validation_metrics(_tagged_suppliers(spark, folder)),
        metrics.validation_metrics(_tagged_parts(spark, folder)),
    ]
    return _rounded(metrics.overall_pass_rate(*both), "pass_rate")


@query
def tenant_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.validation_metrics(_tagged_suppliers(spark, folder), ["tenant_id"]), "pass_rate")


@query
def tenant_part_violations(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.violation_counts(_tagged_parts(spark, folder), ["tenant_id"])


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    per_tenant = metrics.validation_metrics(_tagged_parts(spark, folder), ["tenant_id"])
    return _rounded(metrics.quality_gate(per_tenant, 45.0), "pass_rate")


@query
def domain_rules(spark: SparkSession, folder: str) -> DataFrame:
    tagged = rules.tag(parts(spark, folder), rules.domain_rules(C.PARTS))
    return metrics.violation_profile(tagged)


@query
def freshness_rule(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-01-20T00:00:00Z").cast("timestamp")
    tagged = rules.tag_suppliers(suppliers(spark, folder), [rules.freshness_rule(as_of)])
    return tagged.select("supplier_id", _codes())


# ---------------------------------------------------------------- references


@query
def orphan_defaults(spark: SparkSession, folder: str) -> DataFrame:
    found = references.orphan_defaults(parts(spark, folder), _valid_ids(spark, folder))
    return found.select("part_id", "default_supplier_id")


@query
def orphan_list_members(spark: SparkSession, folder: str) -> DataFrame:
    return references.orphan_list_members(parts(spark, folder), _valid_ids(spark, folder))


@query
def orphan_counts(spark: SparkSession, folder: str) -> DataFrame:
    ids = _valid_ids(spark, folder)
    rows = parts(spark, folder)
    single = references.orphan_defaults(rows, ids).agg(F.count("*").alias("rows"))
    listed = references.orphan_list_members(rows, ids).agg(F.count("*").alias("rows"))
    return single.withColumn("reference", F.lit("default")).unionByName(
        listed.withColumn("reference", F.lit("qualified"))
    )


@query
def parts_with_valid_default(spark: SparkSession, folder: str) -> DataFrame:
    known = members_only(parts(spark, folder), "default_supplier_id", _valid_ids(spark, folder))
    return known.select("part_id", "default_supplier_id")


@query
def default_in_list(spark: SparkSession, folder: str) -> DataFrame:
    return references.default_in_list(parts(spark, folder)).select("part_id", "default_in_list")


@query
def declared_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    every_id = suppliers(spark, folder).select("supplier_id")
    accepted = references.accept_children(parts(spark, folder), "default_supplier_id", every_id)
    return accepted.groupBy("tenant_id").agg(F.count("*").alias("accepted"))


@query
def lineitem_references(spark: SparkSession, folder: str) -> DataFrame:
    """The scalar reference check over the largest table: line items whose supplier is valid."""
    items = table(spark, folder, "lineitem").select(
        "l_linenumber", F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("supplier_id")
    )
    known = members_only(items, "supplier_id", _valid_ids(spark, folder).withColumnRenamed("supplier_id", "valid_id"))
    return known.groupBy("l_linenumber").agg(F.count("*").alias("rows"))


@query
def lineitem_references_answered(spark: SparkSession, folder: str) -> DataFrame:
    """The same with more suppliers than may be broadcast: distinct keys are answered, and the rows stay where they are."""
    items = table(spark, folder, "lineitem").select(
        "l_linenumber", F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0")).alias("supplier_id")
    )
    ids = _valid_ids(spark, folder).withColumnRenamed("supplier_id", "valid_id")
    few = Limits(broadcast_rows=max(1, ids.count() - 1))
    flagged = members_flag(items, "supplier_id", ids, "known", few)
    return flagged.groupBy("l_linenumber").agg(F.count_if("known").alias("rows"))


# ---------------------------------------------------------------- curated and quarantined rows


def _without_clocks(frame: DataFrame) -> DataFrame:
    clocked = ("ingestion_timestamp", "dq_timestamp", "dq_violations")
    moment = utc_text(F.col("source_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("source_timestamp")
    return frame.select(
        *[moment if name == "source_timestamp" else F.col(name) for name in frame.columns if name not in clocked]
    )


@query
def curated_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    rows = curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS)
    return L.geo_to_columns(_without_clocks(rows))


@query
def curated_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = curate.curated_rows(_tagged_parts(spark, folder), C.PARTS)
    return _without_clocks(rows).withColumn("unit_cost", F.col("unit_cost").cast("double"))


@query
def quarantine_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    rows = curate.quarantined_rows(_tagged_suppliers(spark, folder))
    return rows.select("supplier_id", "legal_name", "country", "approved_status", _codes())


@query
def quarantine_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = curate.quarantined_rows(_tagged_parts(spark, folder))
    return rows.select("part_id", "default_supplier_id", "qualified_supplier_ids", "category", _codes())


# ---------------------------------------------------------------- cleaning


@query
def drop_metadata(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.drop_connector_metadata(landed_suppliers(spark, folder))
    return cleaned.select("supplier_id", "supplier_code", "tenant_id", F.lit(len(cleaned.columns)).alias("columns"))


@query
def repair_swap(spark: SparkSession, folder: str) -> DataFrame:
    repaired = clean.repair_swap(landed_suppliers(spark, folder), C.SUPPLIERS)
    return repaired.select("supplier_id", "tenant_id", "supplier_code")


@query
def repair_swap_untouched(spark: SparkSession, folder: str) -> DataFrame:
    repaired = clean.repair_swap(parts(spark, folder), C.PARTS)
    return repaired.select("part_id", "tenant_id", "part_number")


@query
def swap_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(clean.swap_share(landed_suppliers(spark, folder), clean.SWAP_PATTERN[C.SUPPLIERS]), "share")


@query
def cast_contract(spark: SparkSession, folder: str) -> DataFrame:
    cast = clean.cast_contract(landed_suppliers(spark, folder), C.SUPPLIERS)
    return cast.select("supplier_id", *clean.NUMERIC[C.SUPPLIERS])


@query
def cast_contract_parts(spark: SparkSession, folder: str) -> DataFrame:
    cast = clean.cast_contract(landed_parts(spark, folder), C.PARTS)
    return cast.select("part_id", *clean.NUMERIC[C.PARTS]).withColumn("unit_cost", F.col("unit_cost").cast("double"))


@query
def repair_geo(spark: SparkSession, folder: str) -> DataFrame:
    repaired = clean.repair_geo(suppliers(spark, folder))
    shaped = repaired.withColumn("struct_present", F.col("geo_coords").isNotNull())
    return L.geo_to_columns(shaped).select("supplier_id", "geo_lat", "geo_lon", "struct_present")


@query
def text_to_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = landed_parts(spark, folder).withColumn("items", L.text_to_list(F.col("qualified_supplier_ids")))
    return rows.select(
        "part_id", F.size("items").cast("long").alias("items"), F.array_join("items", "|").alias("text")
    )


@query
def geo_json(spark: SparkSession, folder: str) -> DataFrame:
    return L.geo_to_json(clean.repair_geo(suppliers(spark, folder))).select("supplier_id", "geo_coords")


@query
def list_flatten(spark: SparkSession, folder: str) -> DataFrame:
    typed = clean.typed_view(clean.repair_geo(suppliers(spark, folder)), C.SUPPLIERS)
    return L.lists_to_text(typed).select("supplier_id", "certifications", "compliance_flags", "contracts")


@query
def pin_header(spark: SparkSession, folder: str) -> DataFrame:
    partial = parts(spark, folder).drop("hazard_class", "quality_grade", "last_price_change")
    pinned = L.pin_header(partial, C.columns(C.PARTS))
    return pinned.select("part_id", "hazard_class", "quality_grade", "last_price_change", "uom")


@query
def apply_defaults(spark: SparkSession, folder: str) -> DataFrame:
    bare = suppliers(spark, folder).drop("ingestion_timestamp", "schema_version")
    filled = clean.apply_defaults(bare)
    return filled.select("supplier_id", "schema_version", F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@query
def normalised_address(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.normalise_address(suppliers(spark, folder))
    return rows.select("supplier_id", "address_line1", "address_line2", "city")


@query
def typed_view_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    typed = clean.typed_view(clean.repair_geo(suppliers(spark, folder)), C.SUPPLIERS)
    return typed.select(
        "supplier_id",
        F.col("on_time_delivery_rate").cast("double").alias("on_time_delivery_rate"),
        F.col("risk_score").cast("double").alias("risk_score"),
        F.size("certifications").cast("long").alias("certifications"),
        F.size("compliance_flags").cast("long").alias("compliance_flags"),
        utc_text(F.col("source_timestamp"), "yyyy-MM-dd HH:mm:ss").alias("source_timestamp"),
    )


@query
def typed_view_parts(spark: SparkSession, folder: str) -> DataFrame:
    typed = clean.typed_view(parts(spark, folder), C.PARTS)
    return typed.select(
        "part_id",
        F.col("unit_cost").cast("double").alias("unit_cost"),
        F.size("qualified_supplier_ids").cast("long").alias("qualified"),
        F.date_format("last_price_change", "yyyy-MM-dd").alias("last_price_change"),
    )


@query
def sql_staging(spark: SparkSession, folder: str) -> DataFrame:
    return exports.stage_for_sql(clean.repair_geo(suppliers(spark, folder)), C.SUPPLIERS).select(
        "supplier_id", "tenant_id", "supplier_code", "certifications", "compliance_flags", "contracts", "geo_coords"
    )


@query
def sql_staging_parts(spark: SparkSession, folder: str) -> DataFrame:
    staged = exports.stage_for_sql(parts(spark, folder), C.PARTS)
    return staged.select(
        "part_id", "tenant_id", "uom", "unit_cost", "bom_compatibility", "qualified_supplier_ids", "compliance_flags"
    )


# ---------------------------------------------------------------- lookups and scores


@query
def region_currency(spark: SparkSession, folder: str) -> DataFrame:
    country = F.col("country")
    return suppliers(spark, folder).select(
        "supplier_id", "country", derive_region(country).alias("region"), derive_currency(country).alias("currency")
    )


@query
def risk_tiers(spark: SparkSession, folder: str) -> DataFrame:
    score = F.col("risk_score")
    return suppliers(spark, folder).select(
        "supplier_id", risk_tier(score).alias("tier"), risk_tier(score, negative_is_low=True).alias("fast_tier")
    )


@query
def tier_agrees(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.tier_disagreements(suppliers(spark, folder))


@query
def base_risks(spark: SparkSession, folder: str) -> DataFrame:
    return suppliers(spark, folder).select(
        "supplier_id",
        base_risk(F.col("on_time_delivery_rate")).alias("risk"),
        base_risk(F.col("on_time_delivery_rate"), F.col("lead_time_days_avg") - F.lit(30.0)).alias("noisy_risk"),
    )


# ---------------------------------------------------------------- distributions


@query
def country_share(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.shares(suppliers(spark, folder), "country"), "share")


@query
def top_countries(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.top_values(suppliers(spark, folder), "country", 3)


@query
def category_share(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.share_against_spec(parts(spark, folder), "category", synth.CATEGORY_WEIGHTS)
    return _rounded(found, "share")


@query
def lifecycle_share(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.share_against_spec(parts(spark, folder), "lifecycle_status", synth.LIFECYCLE_WEIGHTS)
    return _rounded(found, "share")


@query
def lead_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.average_by(parts(spark, folder), "category", "lead_time_days_avg"), "average")


@query
def rate_risk_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.correlation(suppliers(spark, folder), "on_time_delivery_rate", "risk_score"), "correlation")


@query
def list_size_share(spark: SparkSession, folder: str) -> DataFrame:
    items = L.text_to_list(F.col("qualified_supplier_ids"))
    found = _rounded(metrics.list_sizes(parts(spark, folder), items), "share")
    return found.withColumn("items", F.col("items").cast("long"))


@query
def list_size_bounds(spark: SparkSession, folder: str) -> DataFrame:
    items = L.text_to_list(F.col("qualified_supplier_ids"))
    found = metrics.list_size_bounds(parts(spark, folder), items)
    return found.select(F.col("smallest").cast("long").alias("smallest"), F.col("largest").cast("long").alias("largest"))


@query
def duplicate_surplus(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.duplicate_surplus(parts(spark, folder), ["part_id", "part_number", "default_supplier_id"])


@query
def range_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.range_summary(suppliers(spark, folder), C.RANGES[C.SUPPLIERS])


@query
def range_summary_parts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.range_summary(parts(spark, folder), C.RANGES[C.PARTS])


@query
def anomaly_counts(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-01-20T00:00:00Z").cast("timestamp")
    return metrics.anomaly_counts(suppliers(spark, folder), metrics.supplier_anomalies(as_of))


@query
def anomaly_counts_parts(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-01-20T00:00:00Z").cast("timestamp")
    return metrics.anomaly_counts(parts(spark, folder), metrics.part_anomalies(as_of, C.UNITS))


# ---------------------------------------------------------------- merging


def _supplier_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(table(spark, folder, "supplier"), "s_suppkey", "s_name", "s_acctbal")


def _customer_accounts(spark: SparkSession, folder: str) -> DataFrame:
    rows = accounts(table(spark, folder, "customer"), "c_custkey", "c_name", "c_acctbal")
    return rows.withColumn("balance", F.when(F.col("balance") >= 0, F.col("balance")))


def _order_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(table(spark, folder, "orders"), "o_custkey", "o_orderpriority", "o_totalprice")


@query
def upsert_update(spark: SparkSession, folder: str) -> DataFrame:
    return merge.upsert_update(
        _supplier_accounts(spark, folder), _customer_accounts(spark, folder), "account", ["balance"]
    )


@query
def upsert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    return merge.upsert_ignore(_supplier_accounts(spark, folder), _order_accounts(spark, folder), "account")


@query
def sql_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Parts staged for the database, updated by the cleaned landing batch of the same parts."""
    base = exports.stage_for_sql(parts(spark, folder), C.PARTS)
    batch = exports.stage_for_sql(clean.clean(landed_parts(spark, folder), C.PARTS), C.PARTS)
    merged = merge.upsert_entity(base, batch, C.PARTS)
    return merged.select("part_id", "category", "unit_cost", "moq", "lead_time_days_avg", "qualified_supplier_ids")


@query
def concat_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = [
        _supplier_accounts(spark, folder),
        _customer_accounts(spark, folder).withColumn("origin", F.lit("customer")),
        _order_accounts(spark, folder).drop("name"),
    ]
    return merge.concat_runs(runs)


@query
def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = merge.dedupe_latest(
        table(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )
    return latest.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@query
def streamed_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The same from files that a stream takes two at a time, in any order; a second start finds nothing new."""
    keys, newest = ["l_orderkey", "l_linenumber"], "l_shipdate"
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    place, target, progress = (fresh_folder(spark, label) for label in ("arrivals", "latest", "progress"))
    items = table(spark, folder, "lineitem")
    items.repartition(5, "l_partkey").write.parquet(place)
    late = 0
    for _ in range(2):
        stream = watch_folder(spark, place, items.schema, files_per_batch=2)
        late += load_latest(stream, target, progress, keys, newest, rest, delay="4000 days", span="30 days")
    rows = latest_rows(spark, target, items.schema, keys, newest, rest)
    return rows.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).where(F.lit(late) == 0)


@query
def duplicate_codes(spark: SparkSession, folder: str) -> DataFrame:
    flagged = merge.flag_duplicates(parts(spark, folder), ["tenant_id", "part_number"], "is_duplicate")
    return flagged.select("part_id", "tenant_id", "part_number", "is_duplicate")


@query
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return merge.repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fresh_rows(spark: SparkSession, folder: str) -> DataFrame:
    kept = merge.fresh_rows(table(spark, folder, "events"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), "ts")
    return kept.groupBy("event_type").agg(
        F.count("*").alias("rows"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest")
    )


@query
def incremental_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items shipped after the newest order, as a second load would select them."""
    source = table(spark, folder, "lineitem").withColumnRenamed("l_shipdate", "moment")
    target = table(spark, folder, "orders").withColumnRenamed("o_orderdate", "moment")
    newer = merge.incremental_rows(source, target, "moment")
    return newer.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("moment", "yyyy-MM-dd").alias("l_shipdate")
    )


@query
def incremental_same_moment(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive late, at the very moment the last load reached: those not loaded yet are, the others are not."""
    events = table(spark, folder, "events").withColumn("ts", F.date_trunc("DAY", "ts").cast("timestamp_ntz"))
    day = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    loaded = events.where((F.col("ts") < day) | ((F.col("ts") == day) & (F.col("event_id") % 3 == 0)))
    new = merge.incremental_rows(events, loaded, "ts", keys=["event_id"])
    return new.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query
def incremental_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events loaded as a stream of files, then a second start that finds nothing new."""
    schema = table(spark, folder, "events").schema
    target, progress = fresh_folder(spark, "stream-target"), fresh_folder(spark, "stream-progress")
    for _ in range(2):
        load_new_files(watch_folder(spark, folder, schema, "events.parquet"), target, progress)
    loaded = spark.read.schema(schema).parquet(f"{target}/batch=*")
    return loaded.groupBy("event_type").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("events"))


# ---------------------------------------------------------------- contract


@query
def contract_fields(spark: SparkSession, folder: str) -> DataFrame:
    one = checks.field_report(suppliers(spark, folder), C.SUPPLIERS).withColumn("entity", F.lit(C.SUPPLIERS))
    two = checks.field_report(parts(spark, folder), C.PARTS).withColumn("entity", F.lit(C.PARTS))
    return one.unionByName(two).select("entity", "field", "present", "filled")


@query
def contract_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Contract fields of the landed suppliers without two of them, and the values filled in those of the mapped table."""
    covered = checks.field_coverage(landed_suppliers(spark, folder).drop("region", "geo_coords"), C.SUPPLIERS)
    rows = suppliers(spark, folder).drop("region", "geo_coords")
    filled = rows.agg(reduce(lambda a, b: a + b, [F.count(name) for name in rows.columns]).alias("filled"))
    return covered.withColumn("filled", filled.scalar())


@query
def contract_types(spark: SparkSession, folder: str) -> DataFrame:
    raw = checks.type_report(landed_suppliers(spark, folder), C.SUPPLIERS).withColumn("state", F.lit("landed"))
    cast = clean.clean(landed_suppliers(spark, folder), C.SUPPLIERS)
    cleaned = checks.type_report(cast, C.SUPPLIERS).withColumn("state", F.lit("cleaned"))
    return raw.unionByName(cleaned)


@query
def drift_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.drift_report(landed_parts(spark, folder).drop("hazard_class"), C.PARTS)


@query
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return checks.contract_violations(clean.repair_geo(suppliers(spark, folder)), C.SUPPLIERS)


@query
def contract_violations_landed(spark: SparkSession, folder: str) -> DataFrame:
    return checks.contract_violations(suppliers(spark, folder), C.SUPPLIERS)


@query
def contract_verdict(spark: SparkSession, folder: str) -> DataFrame:
    curated = curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS)
    one = checks.verdict(checks.contract_violations(curated, C.SUPPLIERS)).withColumn("entity", F.lit(C.SUPPLIERS))
    curated_part_rows = curate.curated_rows(_tagged_parts(spark, folder), C.PARTS)
    two = checks.verdict(checks.contract_violations(curated_part_rows, C.PARTS)).withColumn("entity", F.lit(C.PARTS))
    return one.unionByName(two)


@query
def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.constraint_report(suppliers(spark, folder), C.SUPPLIERS)


@query
def constraint_report_parts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.constraint_report(parts(spark, folder), C.PARTS)


@query
def id_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the mapping are too short; ids synthesised for the same suppliers are well formed."""
    ids = table(spark, folder, "supplier").select("s_suppkey")
    mapped = checks.id_shape(suppliers(spark, folder), "supplier_id").withColumn("origin", F.lit("mapped"))
    made = checks.id_shape(synth.synth_suppliers(ids), "supplier_id").withColumn("origin", F.lit("synthesised"))
    return mapped.unionByName(made)


@query
def timestamp_shape(spark: SparkSession, folder: str) -> DataFrame:
    names = ["source_timestamp", "ingestion_timestamp", "last_price_change", "part_number"]
    return checks.timestamp_shape(parts(spark, folder), names)


@query
def list_domain(spark: SparkSession, folder: str) -> DataFrame:
    found = checks.outside_domain(suppliers(spark, folder), "certifications", C.CERTIFICATIONS)
    return found.select("supplier_id", F.array_join("unknown_items", ",").alias("unknown_items"))


# ---------------------------------------------------------------- files and tables


@query
def roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    exports.write_csv_flat(clean.repair_geo(suppliers(spark, folder)), path, C.SUPPLIERS)
    return landing.read_csv(spark, path, C.SUPPLIERS).select(
        "supplier_id", "legal_name", "address_line1", "certifications", "lead_time_days_avg", "geo_coords"
    )


@query
def roundtrip_csv_parts(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    exports.write_csv_flat(clean.typed_view(parts(spark, folder), C.PARTS).drop("spec_hash"), path, C.PARTS)
    return landing.read_csv(spark, path, C.PARTS).select(
        "part_id", "spec_hash", "hazard_class", "qualified_supplier_ids", "bom_compatibility", "moq"
    )


@query
def roundtrip_csv_chunked(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "csv")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    exports.write_csv_chunked(rows, path, rows_per_file=1000)
    names = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    back = landing.read_csv(spark, path, C.SUPPLIERS, names)
    return back.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("rows"), F.sum(F.col("o_orderkey").cast("long")).alias("keys")
    )


@query
def roundtrip_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark, "parquet")
    typed = clean.typed_view(clean.repair_geo(suppliers(spark, folder)), C.SUPPLIERS)
    exports.write_parquet_flat(typed, path)
    back = spark.read.parquet(path)
    return back.select("supplier_id", "certifications", "contracts", "geo_lat", "geo_lon")


def _landed_twice(spark: SparkSession, folder: str) -> str:
    """Two runs of one day for suppliers and one for parts, in the landing layout."""
    root = fresh_folder(spark, "landing")
    for run_id in ("20240131_060000", "20240131_180000"):
        rows = landed_suppliers(spark, folder)
        rows.write.parquet(landing.run_folder(root, "tenant_a", C.SUPPLIERS, "2024-01-31", run_id))
    rows = landed_parts(spark, folder)
    rows.write.parquet(landing.run_folder(root, "tenant_a", C.PARTS, "2024-01-31", "20240131_060000"))
    return root


@query
def landing_lineage(spark: SparkSession, folder: str) -> DataFrame:
    root = _landed_twice(spark, folder)
    both = [
        landing.with_lineage(landing.read_landing(spark, root, "tenant_a", entity, "2024-01-31")).groupBy(
            "landing_tenant", "landing_entity", "landing_date", "landing_run_id"
        )
        for entity in C.ENTITIES
    ]
    return both[0].agg(F.count("*").alias("rows")).unionByName(both[1].agg(F.count("*").alias("rows")))


@query
def landing_uploads(spark: SparkSession, folder: str) -> DataFrame:
    """Runs in the layout of uploaded files, told by their paths."""
    root = fresh_folder(spark, "uploads")
    for tenant, entity, rows in (("tenant_a", "suppliers", suppliers(spark, folder)), ("tenant b", "parts", parts(spark, folder))):
        rows.write.parquet(f"{root}/{tenant}/2024-01-31/20240131_060000/{entity}.parquet")
    frames = [
        landing.with_upload_lineage(spark.read.parquet(f"{root}/*/2024-01-31/*/{entity}*"))
        .groupBy("landing_tenant", "landing_entity", "landing_date", "landing_run_id")
        .agg(F.count("*").alias("rows"))
        for entity in C.ENTITIES
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def all_tenants(spark: SparkSession, folder: str) -> DataFrame:
    """Two tenants landed the same suppliers; one job reads and rates both."""
    root = fresh_folder(spark, "landing")
    for tenant in ("tenant_a", "tenant_b"):
        path = landing.run_folder(root, tenant, C.SUPPLIERS, "2024-01-31", "20240131_060000")
        suppliers(spark, folder).write.parquet(path)
    rows = landing.with_lineage(landing.read_landing(spark, root, "*", C.SUPPLIERS, "2024-01-31"))
    return _rounded(metrics.validation_metrics(rules.tag_suppliers(rows), ["landing_tenant"]), "pass_rate")


@query
def streamed_curation(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files curated by a stream; the second start finds nothing new."""
    root, target, progress = (fresh_folder(spark, label) for label in ("landing", "curated", "progress"))
    landed = landed_parts(spark, folder)
    ids = suppliers(spark, folder).select("supplier_id")
    landed.write.parquet(f"{root}/run")
    for _ in range(2):
        stream = watch_folder(spark, f"{root}/run", landed.schema)
        curate_new_files(stream, C.PARTS, target, progress, ids)
    stored = spark.read.schema(C.curated_schema(C.PARTS)).option("basePath", target).parquet(f"{target}/batch=*")
    return metrics.violation_profile(stored)


@query
def missing_source(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers land, parts do not: the job goes on with suppliers alone."""
    root = fresh_folder(spark, "landing")
    path = landing.run_folder(root, "tenant_a", C.SUPPLIERS, "2024-01-31", "20240131_060000")
    exports.write_parquet_json_geo(suppliers(spark, folder), path)
    found = landing.read_or_none(
        lambda: landing.read_landing(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31"), required=True
    )
    absent = landing.read_or_none(lambda: landing.read_landing(spark, root, "tenant_a", C.PARTS, "2024-01-31"))
    tagged = curation.tag_both(found, absent, stage=False)
    return _rounded(curation.report(tagged), "pass_rate")


@query
def overwrite_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Load all tenants, then reload them from a corrected source: rows are replaced, not added."""
    path = fresh_folder(spark, "reload")
    first = _tagged_parts(spark, folder).select("part_id", "tenant_id", "is_valid")
    for _ in range(2):
        tables.overwrite_partitions(first, path, ("tenant_id",))
    back = spark.read.parquet(path)
    return back.groupBy("tenant_id").agg(F.count("*").alias("rows"), F.count_if("is_valid").alias("valid"))


def _curated_twice(spark: SparkSession, folder: str, replace: bool) -> str:
    location = fresh_folder(spark, "curated")
    name = f"curated_{location.rsplit('-', 1)[1]}"
    tables.create_curated_table(spark, C.SUPPLIERS, name, location)
    rows = curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS)
    for _ in range(2):
        tables.append_rows(rows, C.SUPPLIERS, name, replace)
    return name


@query
def append_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Appending the same run twice accumulates."""
    name = _curated_twice(spark, folder, replace=False)
    shaped = F.lit(tables.has_struct_column(spark, name)).alias("geo_is_struct")
    return tables.read_table(spark, name).groupBy("tenant_id").agg(F.count("*").alias("rows")).select("*", shaped)


@query
def reload_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Reloading the same run twice changes nothing."""
    name = _curated_twice(spark, folder, replace=True)
    return tables.read_table(spark, name).select("supplier_id", "tenant_id", "risk_score", "geo_coords.lat")


@query
def compacted_table(spark: SparkSession, folder: str) -> DataFrame:
    name = _curated_twice(spark, folder, replace=False)
    tables.compact_partitions(spark, name, C.SUPPLIERS, {"landing_date": C.UNDATED})
    return tables.read_table(spark, name).groupBy("supplier_id").agg(F.count("*").alias("rows"))


@query
def compaction_report(spark: SparkSession, folder: str) -> DataFrame:
    """Of a table whose partitions were written once, one of them four times, only the latter is worth rewriting."""
    location = fresh_folder(spark, "curated")
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"curated_{location.rsplit('-', 1)[1]}", location)
    rows = staged(curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS), "rows")
    tables.append_rows(rows, C.SUPPLIERS, name)
    for _ in range(3):
        tables.append_rows(rows.where("tenant_id = 'tenant_1'"), C.SUPPLIERS, name)
    told = staged(tables.compact_partitions(spark, name, C.SUPPLIERS), "told")
    again = tables.compact_partitions(spark, name, C.SUPPLIERS).count()
    kept = tables.read_table(spark, name).groupBy("tenant_key").agg(F.count("*").alias("rows"))
    return kept.join(told, "tenant_key").select(
        "tenant_key", "rows", (F.col("before") >= 2 * F.col("after")).alias("fewer_files"), F.lit(again).cast("long").alias("left_to_do")
    )


@query
def upsert_curated(spark: SparkSession, folder: str) -> DataFrame:
    """Curated suppliers updated, twice, by the valid rows of a later landing batch."""
    location = fresh_folder(spark, "curated")
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"curated_{location.rsplit('-', 1)[1]}", location)
    tables.append_rows(curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS), C.SUPPLIERS, name)
    later = rules.tag_suppliers(clean.clean(landed_suppliers(spark, folder), C.SUPPLIERS))
    for _ in range(2):
        tables.upsert_rows(curate.curated_rows(later, C.SUPPLIERS), C.SUPPLIERS, name)
    return spark.table(name).select(
        "supplier_id", "tenant_id", "risk_score", "on_time_delivery_rate", "defect_rate_ppm", "lead_time_days_avg"
    )


@query
def curation_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job from landing files to report. The two supplier runs of the day are read together."""
    root = _landed_twice(spark, folder)
    place = fresh_folder(spark, "job")
    database = f"curated_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}/db'")
    done = curation.run(
        spark, root, "tenant_a", "2024-01-31", database, f"{place}/curated", f"{place}/quarantine"
    )
    return _rounded(done, "pass_rate")


# ---------------------------------------------------------------- synthesis


AS_OF = "2024-01-31T00:00:00Z"


def _made_suppliers(spark: SparkSession, folder: str, variant: str = synth.FULL) -> DataFrame:
    ids = table(spark, folder, "orders").select("o_orderkey")
    return synth.synth_suppliers(ids, as_of=AS_OF, variant=variant)


def _made_parts(spark: SparkSession, folder: str, variant: str = synth.FULL) -> DataFrame:
    """Parts numbered by order key that refer to suppliers synthesised from customer keys."""
    ids = table(spark, folder, "orders").select("o_orderkey")
    parents = synth.synth_suppliers(table(spark, folder, "customer").select("c_custkey")).select("supplier_id")
    return synth.synth_parts(ids, parents, as_of=AS_OF, variant=variant)


def _spec_rows(frame: DataFrame, column: str, expected: dict, tolerance: float = 0.05) -> DataFrame:
    found = metrics.share_against_spec(frame, column, expected, tolerance)
    return found.select(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), "expected", "within")


def _stack(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query
def synth_suppliers_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of the synthetic suppliers next to their specification."""
    made = _made_suppliers(spark, folder).select(
        "country",
        "approved_status",
        "incoterms",
        F.size("certifications").cast("string").alias("certification_count"),
        F.size("compliance_flags").cast("string").alias("flag_count"),
    )
    total = sum(synth.COUNTRY_WEIGHTS.values())
    return _stack(
        [
            _spec_rows(made, "country", {key: weight / total for key, weight in synth.COUNTRY_WEIGHTS.items()}),
            _spec_rows(made, "approved_status", synth.STATUS_WEIGHTS),
            _spec_rows(made, "incoterms", dict(zip(C.INCOTERMS, synth.INCOTERM_WEIGHTS))),
            _spec_rows(made, "certification_count", {str(k): w for k, w in synth.LIST_SIZE_WEIGHTS.items()}),
            _spec_rows(made, "flag_count", {str(k): w for k, w in synth.FLAG_COUNT_WEIGHTS.items()}),
        ]
    )


@query
def synth_suppliers_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Row count, unique ids, value ranges, moments and correlation of the synthetic suppliers."""
    made = _made_suppliers(spark, folder)
    return made.agg(
        F.count("*").alias("rows"),
        F.countDistinct("supplier_id").alias("ids"),
        F.bool_and(F.col("on_time_delivery_rate").between(60, 100)).alias("rate_in_range"),
        F.bool_and(F.col("risk_score").between(0, 100)).alias("risk_in_range"),
        F.bool_and(F.col("lead_time_days_avg").between(3, 90)).alias("lead_in_range"),
        F.bool_and(F.col("lead_time_days_p95").between(7, 180)).alias("p95_in_range"),
        F.bool_and(F.col("capacity_units_per_week") >= 100).alias("capacity_in_range"),
        F.bool_and(F.col("financial_risk_tier") == risk_tier(F.col("risk_score"))).alias("tiers_agree"),
        F.bool_and(F.size("contracts") <= 2).alias("contracts_in_range"),
        F.bool_and(F.try_to_timestamp("source_timestamp") <= F.lit(AS_OF).cast("timestamp")).alias("past_only"),
        (F.abs(F.avg("lead_time_days_avg") - 20.5) < 0.5).alias("lead_mean_holds"),
        (F.corr("on_time_delivery_rate", "risk_score") < -0.3).alias("risk_follows_rate"),
    )


@query
def synth_parts_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of the synthetic parts next to their specification."""
    made = _made_parts(spark, folder).select(
        "category",
        "lifecycle_status",
        "uom",
        "quality_grade",
        F.size("qualified_supplier_ids").cast("string").alias("list_size"),
        F.col("hazard_class").isNotNull().cast("string").alias("hazardous"),
    )
    return _stack(
        [
            _spec_rows(made, "category", synth.CATEGORY_WEIGHTS),
            _spec_rows(made, "lifecycle_status", synth.LIFECYCLE_WEIGHTS),
            _spec_rows(made, "uom", synth.UNIT_WEIGHTS),
            _spec_rows(made, "quality_grade", synth.GRADE_WEIGHTS),
            _spec_rows(made, "list_size", {str(k): w for k, w in synth.LIST_SIZE_WEIGHTS.items()}),
            _spec_rows(made, "hazardous", {"true": 0.1, "false": 0.9}),
        ]
    )


@query
def synth_parts_references(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic parts refer to existing suppliers only, never twice to the same, default first."""
    made = _made_parts(spark, folder)
    parents = synth.synth_suppliers(table(spark, folder, "customer").select("c_custkey")).select("supplier_id")
    listed = F.col("qualified_supplier_ids")
    checked = references.check_references(made, parents)
    return checked.agg(
        F.count("*").alias("rows"),
        F.countDistinct("part_id").alias("ids"),
        F.count_if(~F.col("_default_known")).alias("orphan_defaults"),
        F.count_if("_list_broken").alias("orphan_lists"),
        F.count_if(F.size(F.array_distinct(listed)) < F.size(listed)).alias("repeating_lists"),
        F.count_if(F.col("default_supplier_id") != F.element_at(listed, 1)).alias("default_not_first"),
        F.bool_and(F.col("unit_cost") > 0).alias("cost_positive"),
        (
            F.avg(F.when(F.col("category") == "ELECTRICAL", F.col("lead_time_days_avg")))
            > F.avg(F.when(F.col("category") == "RAW_MATERIAL", F.col("lead_time_days_avg")))
        ).alias("electrical_slower"),
    )


@query
def injected_profile(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows differ after damaging 6 percent, and that no row carries two kinds of damage."""
    made = _made_suppliers(spark, folder)
    dirty = dirt.inject_anomalies(made, C.SUPPLIERS, 0.06, as_of=AS_OF)
    late = F.try_to_timestamp("source_timestamp") > F.lit(AS_OF).cast("timestamp")
    seen = [
        F.col("on_time_delivery_rate") == dirt.OUT_OF_RANGE_RATE,
        F.col("contact_email").isNull(),
        F.col("country") == C.BOGUS_COUNTRY,
        late,
    ]
    marks = seen[0].cast("int")
    for mark in seen[1:]:
        marks = marks + mark.cast("int")
    before = made.select(F.col("supplier_id").alias("id"), F.col("supplier_code").alias("code"))
    compared = dirty.join(before, F.col("supplier_id") == F.col("id"))
    changed = F.col("supplier_code") != F.col("code")
    return compared.select(marks.alias("marks"), changed.cast("int").alias("recoded")).agg(
        F.count("*").alias("rows"),
        F.sum(F.col("marks") + F.col("recoded")).alias("damaged"),
        F.max(F.col("marks") + F.col("recoded")).cast("long").alias("most_per_row"),
    )


@query
def injected_parts_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with 6 percent damage that spares keys: counts per kind add up exactly."""
    made = _made_parts(spark, folder)
    dirty = dirt.inject_anomalies(made, C.PARTS, 0.06, as_of=AS_OF, fast=True)
    late = F.try_to_timestamp("source_timestamp") > F.lit(AS_OF).cast("timestamp")
    marks = (
        (F.col("unit_cost") < 0).cast("int") + (F.col("uom") == dirt.FAST_WRONG_UNIT).cast("int") + late.cast("int")
    )
    return dirty.agg(F.count("*").alias("rows"), F.sum(marks).alias("damaged"), F.max(marks).cast("long").alias("most_per_row"))


@query
def injected_parts_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Each kind of damage to parts, found by its own test: orphan ids in both key columns, copied numbers and the rest.

    One hundredth of the rows is damaged by one kind at a time, then six by all kinds together, one kind each.
    """
    parents = synth.synth_suppliers(table(spark, folder, "customer").select("c_custkey")).select("supplier_id")
    parents = staged(parents, "parents")
    size = measure(parents)
    # what the tests look at, and number, first supplier and whether it is known as they were before the damage
    columns = ["part_id", "part_number", "unit_cost", "uom", "default_supplier_id", "qualified_supplier_ids", "source_timestamp"]
    made = _made_parts(spark, folder).select(
        *columns, F.col("part_number").alias("number"), F.col("default_supplier_id").alias("first_id")
    )
    made = staged(members_flag(made, "first_id", parents, "first_known", size=size), "parts")
    drawn = {rate: dirt.exact_sample(made, "part_id", rate, 42) for rate in (0.01, 0.06)}
    late = F.try_to_timestamp("source_timestamp") > F.lit(AS_OF).cast("timestamp")

    def marked(dirty: DataFrame) -> DataFrame:
        # ids that are as they were have their answer; the others are looked up
        same = F.col("default_supplier_id").eqNullSafe(F.col("first_id"))
        asked = dirty.withColumn("asked", F.when(~same, F.col("default_supplier_id")))
        found = members_flag(asked, "asked", parents, "other_known", size=size)
        known = found.withColumn("known", F.when(same, F.col("first_known")).otherwise(F.col("other_known")))
        alone = F.col("qualified_supplier_ids") == F.array("default_supplier_id")
        tests = {
            "negative_cost": F.col("unit_cost") < 0,
            "wrong_uom": F.col("uom") == dirt.WRONG_UNIT,
            "invalid_supplier_id": ~F.col("known") & alone,
            "future_timestamp": late,
            "duplicate_part_number": F.col("part_number") != F.col("number"),
        }
        return known.select(*[F.coalesce(test, F.lit(False)).cast("int").alias(kind) for kind, test in tests.items()])

    frames = []
    for kinds in [*[(kind,) for kind in dirt.KINDS[C.PARTS]], dirt.KINDS[C.PARTS]]:
        rate = 0.01 if len(kinds) == 1 else 0.06
        found = marked(dirt.inject_anomalies(made, C.PARTS, rate, kinds=kinds, as_of=AS_OF, chosen=drawn[rate]))
        total = sum((F.col(kind) for kind in found.columns), F.lit(0))
        own = total if len(kinds) > 1 else F.col(kinds[0])
        frames.append(
            found.agg(F.count("*").alias("rows"), F.sum(own).alias("damaged"), F.sum(total).alias("marks"),
                      F.max(total).cast("long").alias("most_per_row"))
            .withColumn("kind", F.lit(kinds[0] if len(kinds) == 1 else "all"))
        )
    return reduce(DataFrame.unionByName, frames)


@query
def sampled_rows(spark: SparkSession, folder: str) -> DataFrame:
    """An exact share of all orders, without replacement."""
    orders = table(spark, folder, "orders")
    picked = dirt.sample_rows(orders, "o_orderkey", 0.06, seed=7)
    return picked.agg(F.count("*").alias("rows"), F.countDistinct("o_orderkey").alias("orders"))


@query
def dataset_job(spark: SparkSession, folder: str) -> DataFrame:
    """Make, damage, export and land suppliers for all customer keys and parts for all part keys, then curate them.

    Of the damaged suppliers (6 percent) the rules see two kinds in four, of the damaged parts one kind in
    three, and a part fails with any of its one to three suppliers.
    """
    owners = table(spark, folder, "customer").select("c_custkey")
    items = table(spark, folder, "part").select("p_partkey")
    place = fresh_folder(spark, "dataset")
    made = dataset.export_dataset(
        dataset.make_dataset(spark, owners, items, as_of=AS_OF, variant=synth.FAST), f"{place}/files"
    )
    dataset.land_dataset(made, place, "tenant_a", "2024-01-31", "20240131_060000")
    database = f"dataset_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}/db'")
    done = curation.run(spark, place, "tenant_a", "2024-01-31", database, f"{place}/curated")
    sound = 1 - 0.06 * 2 / 4
    sound_parts = (1 - 0.06 / 3) * (sound + sound**2 + sound**3) / 3
    predicted = (
        F.when(F.col("entity") == C.SUPPLIERS, 100 * sound)
        .when(F.col("entity") == C.PARTS, 100 * sound_parts)
    )
    # "overall" weighs both tables by their rows
    sizes = done.where("entity <> 'overall'").agg(
        F.sum(F.when(F.col("entity") == C.SUPPLIERS, F.col("total") * sound).otherwise(F.col("total") * sound_parts))
        * 100 / F.sum("total")
    )
    expected = F.when(F.col("entity") == "overall", sizes.scalar()).otherwise(predicted)
    return done.select("entity", "total", (F.abs(F.col("pass_rate") - expected) < 5).alias("as_predicted"))


# ---------------------------------------------------------------- reloads, runs and tenants


def _land(spark: SparkSession, root: str, frame: DataFrame, tenant: str, date: str, hour: str = "06") -> None:
    run_id = f"{date.replace('-', '')}_{hour}0000"
    frame.write.parquet(landing.run_folder(root, tenant, C.SUPPLIERS, date, run_id))


def _job_folders(spark: SparkSession) -> dict:
    place = fresh_folder(spark, "job")
    database = f"curated_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}/db'")
    return {"database": database, "location": f"{place}/curated", "quarantine": f"{place}/quarantine"}


def _stored(spark: SparkSession, folders: dict) -> DataFrame:
    return spark.table(f"{folders['database']}.{C.CURATED_TABLE[C.SUPPLIERS]}")


def _refused(spark: SparkSession, folders: dict) -> DataFrame:
    return spark.read.parquet(f"{folders['quarantine']}/{C.SUPPLIERS}")


@query
def reload_second_date(spark: SparkSession, folder: str) -> DataFrame:
    """Two dates curated, the second one twice: each date holds its rows once, curated and rejected."""
    root, folders = fresh_folder(spark, "landing"), _job_folders(spark)
    for date in ("2024-01-30", "2024-01-31"):
        _land(spark, root, suppliers(spark, folder), "tenant_a", date)
    for date in ("2024-01-30", "2024-01-31", "2024-01-31"):
        curation.run(spark, root, "tenant_a", date, replace=True, **folders)
    kept = _stored(spark, folders).groupBy("landing_date").agg(F.count("*").alias("kept"))
    refused = _refused(spark, folders).groupBy(F.col("landing_date").cast("string").alias("landing_date")).agg(
        F.count("*").alias("refused")
    )
    return kept.join(refused, "landing_date")


@query
def reload_to_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A date is landed anew without a valid row: its curated rows go, those of the day before stay."""
    root, again, folders = fresh_folder(spark, "landing"), fresh_folder(spark, "landing"), _job_folders(spark)
    for date in ("2024-01-30", "2024-01-31"):
        _land(spark, root, suppliers(spark, folder), "tenant_a", date)
        curation.run(spark, root, "tenant_a", date, replace=True, **folders)
    broken = suppliers(spark, folder).withColumn("legal_name", F.lit(None).cast("string"))
    _land(spark, again, broken, "tenant_a", "2024-01-31")
    curation.run(spark, again, "tenant_a", "2024-01-31", replace=True, **folders)
    refused = _refused(spark, folders).groupBy(F.col("landing_date").cast("string").alias("landing_date")).agg(
        F.count("*").alias("refused")
    )
    kept = _stored(spark, folders).groupBy("landing_date").agg(F.count("*").alias("kept"))
    return refused.join(kept, "landing_date", "left").select(
        "landing_date", F.coalesce("kept", F.lit(0)).alias("kept"), "refused"
    )


@query
def quarantine_two_tenants(spark: SparkSession, folder: str) -> DataFrame:
    """Two tenants curated one after the other: both keep their rejected rows, with the run they came from."""
    root, folders = fresh_folder(spark, "landing"), _job_folders(spark)
    for tenant in ("tenant_a", "tenant_b"):
        named = suppliers(spark, folder).withColumn("tenant_id", F.lit(tenant))
        _land(spark, root, named, tenant, "2024-01-31")
        curation.run(spark, root, tenant, "2024-01-31", replace=True, **folders)
    return _refused(spark, folders).groupBy("tenant_id", "landing_run_id").agg(F.count("*").alias("rows"))


@query
def curated_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Curated rows name the run they came from."""
    root, folders = fresh_folder(spark, "landing"), _job_folders(spark)
    for hour in ("06", "18"):
        _land(spark, root, suppliers(spark, folder), "tenant_a", "2024-01-31", hour)
    curation.run(spark, root, "tenant_a", "2024-01-31", **folders)
    return _stored(spark, folders).groupBy("landing_date", "landing_run_id").agg(F.count("*").alias("rows"))


@query
def all_tenants_job(spark: SparkSession, folder: str) -> DataFrame:
    """One job over two tenants, with a rate and a gate for each."""
    root, folders = fresh_folder(spark, "landing"), _job_folders(spark)
    rows = suppliers(spark, folder)
    _land(spark, root, rows, "tenant_a", "2024-01-31")
    _land(spark, root, rows.withColumn("legal_name", F.lit(None).cast("string")), "tenant_b", "2024-01-31")
    done = curation.run(spark, root, "*", "2024-01-31", by_tenant=True, threshold=50.0, **folders)
    return _rounded(done, "pass_rate").drop("geo_is_struct")


@query
def tenant_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Three tenants as jobs side by side; one has landed a file that is none, and the others are stored all the same."""
    root, folders = fresh_folder(spark, "landing"), _job_folders(spark)
    rows = suppliers(spark, folder)
    _land(spark, root, rows, "tenant_a", "2024-01-31")
    _land(spark, root, rows.where("tenant_id <> 'tenant_1'"), "tenant_c", "2024-01-31")
    broken = landing.run_folder(root, "tenant_b", C.SUPPLIERS, "2024-01-31", "20240131_060000")
    rows.select("supplier_id").write.text(broken.replace("suppliers.parquet", "suppliers_of_b.parquet"))
    told = curation.run_tenants(spark, root, "2024-01-31", threshold=50.0, **folders)
    kept = _stored(spark, folders).agg(F.count("*")).scalar().alias("stored")
    failed = F.col("error").isNotNull().alias("failed")
    return _rounded(told, "pass_rate").select("tenant", "entity", "total", "valid", "pass_rate", "passed", failed, kept)


@query
def upsert_empty_tenant(spark: SparkSession, folder: str) -> DataFrame:
    """An upsert into a table whose tenant is the empty text keeps the tenant's other rows."""
    location = fresh_folder(spark, "curated")
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"curated_{location.rsplit('-', 1)[1]}", location)
    rows = curate.curated_rows(_tagged_suppliers(spark, folder), C.SUPPLIERS).withColumn("tenant_id", F.lit(""))
    tables.append_rows(rows, C.SUPPLIERS, name)
    few = rows.where("supplier_id LIKE '%7'").withColumn("risk_score", F.lit(1.0))
    new = few.withColumn("supplier_id", F.concat("supplier_id", F.lit("-new")))
    tables.upsert_rows(few.unionByName(new), C.SUPPLIERS, name)
    return spark.table(name).select("supplier_id", "tenant_id", "risk_score")


def _two_runs(spark: SparkSession, folder: str, first: DataFrame, second: DataFrame) -> str:
    root = fresh_folder(spark, "landing")
    _land(spark, root, first, "tenant_a", "2024-01-31", "06")
    _land(spark, root, second, "tenant_a", "2024-01-31", "18")
    return root


@query
def repair_swap_mixed_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A sound run and one with exchanged columns on one day: only the latter is exchanged back."""
    root = _two_runs(spark, folder, suppliers(spark, folder), landed_suppliers(spark, folder))
    runs = landing.read_runs(spark, root, "*", C.SUPPLIERS, "2024-01-31")
    return clean.repair_swap(runs, C.SUPPLIERS).select("landing_run_id", "supplier_id", "tenant_id", "supplier_code")


@query
def landing_type_drift(spark: SparkSession, folder: str) -> DataFrame:
    """A column is a number in one run and text in the next: both are read and cast."""
    rows = suppliers(spark, folder)
    root = _two_runs(spark, folder, rows, rows.withColumn("defect_rate_ppm", F.col("defect_rate_ppm").cast("string")))
    runs = clean.cast_contract(landing.read_runs(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31"), C.SUPPLIERS)
    return runs.groupBy("landing_run_id").agg(F.count("*").alias("rows"), F.sum("defect_rate_ppm").alias("ppm"))


@query
def landing_int_double_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers in one run and doubles in the next, large and small ones: no value is lost on the way to the cast."""
    rows = suppliers(spark, folder)
    number = F.substring("supplier_id", 2, 8).cast("int")
    large, small = number % 1000 * 1_000_000 + 12_345_678, number / 10_000
    one = rows.withColumns({"capacity_units_per_week": large, "defect_rate_ppm": F.lit(7)})
    two = rows.withColumns({"capacity_units_per_week": large.cast("double"), "defect_rate_ppm": small})
    root = _two_runs(spark, folder, one, two)
    landed = landing.read_runs(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31")
    kinds = dict(landed.dtypes)
    kind = F.lit(f"{kinds['capacity_units_per_week']},{kinds['defect_rate_ppm']}").alias("landed_as")
    cast = clean.cast_contract(landed.withColumn("as_landed", F.col("defect_rate_ppm")), C.SUPPLIERS)
    return cast.select(
        "landing_run_id", "supplier_id", kind, "capacity_units_per_week", "defect_rate_ppm",
        F.round(F.col("as_landed") * 10_000).cast("long").alias("ten_thousandths"),
    )


@query
def landing_text_double_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Doubles in one run and text in the next: the doubles are printed so that the cast reads them."""
    rows = suppliers(spark, folder)
    number = F.substring("supplier_id", 2, 8).cast("int")
    one = rows.withColumn("capacity_units_per_week", (number % 1000 * 1_000_000 + 12_345_678).cast("double"))
    two = rows.withColumn("capacity_units_per_week", F.concat(F.lit(" "), number.cast("string"), F.lit(".9")))
    root = _two_runs(spark, folder, one, two)
    landed = landing.read_runs(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31")
    return clean.cast_contract(landed, C.SUPPLIERS).select("landing_run_id", "supplier_id", "capacity_units_per_week")


@query
def cast_contract_exponents(spark: SparkSession, folder: str) -> DataFrame:
    """Text numbers with exponents, as some writers print them, are read on request."""
    return clean.cast_contract(landed_suppliers(spark, folder), C.SUPPLIERS, exponents=True).select(
        "supplier_id", "defect_rate_ppm", "capacity_units_per_week"
    )


@query
def landing_column_drift(spark: SparkSession, folder: str) -> DataFrame:
    """A column is missing in one run: it is kept for the others, and the drift is told run by run."""
    rows = suppliers(spark, folder)
    root = _two_runs(spark, folder, rows.drop("legal_name"), rows)
    schemas = landing.landed_schemas(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31")
    runs = landing.read_runs(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31", schemas)
    found = runs.groupBy("landing_run_id").agg(F.count("*").alias("rows"), F.count("legal_name").alias("named"))
    drift = landing.run_drift(spark, root, "tenant_a", C.SUPPLIERS, "2024-01-31", schemas)
    return found.join(drift, "landing_run_id")


@query
def roundtrip_csv_newlines(spark: SparkSession, folder: str) -> DataFrame:
    """Line breaks, quotes and commas inside fields survive a CSV file."""
    path = fresh_folder(spark, "csv")
    odd = F.concat(F.lit('say "'), "description", F.lit('",\nline two\n'), "part_id")
    exports.write_csv_flat(clean.typed_view(parts(spark, folder).withColumn("description", odd), C.PARTS), path, C.PARTS)
    return landing.read_csv(spark, path, C.PARTS).select("part_id", "description", "uom")


@query
def roundtrip_csv_split(spark: SparkSession, folder: str) -> DataFrame:
    """A file without line breaks in its fields may be split among tasks."""
    path = fresh_folder(spark, "csv")
    exports.write_csv_flat(clean.typed_view(parts(spark, folder), C.PARTS), path, C.PARTS)
    return landing.read_csv(spark, path, C.PARTS, line_breaks=False).select("part_id", "description", "uom")


@query
def roundtrip_csv_reordered(spark: SparkSession, folder: str) -> DataFrame:
    """A file with its columns in another order, and one more, is read by its header."""
    path = fresh_folder(spark, "csv")
    rows = parts(spark, folder).selectExpr("uom", "1 AS extra", "tenant_id", "description", "part_id")
    exports.write_csv_chunked(rows, path)
    return landing.read_csv(spark, path, C.PARTS).select("part_id", "tenant_id", "description", "uom", "category")


@query
def incremental_null_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a cursor value are loaded, whatever was loaded before."""
    events = table(spark, folder, "events").withColumn("ts", F.expr("CASE WHEN event_id % 10 <> 3 THEN ts END"))
    loaded = events.where(F.col("ts") <= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    new = merge.incremental_rows(events, loaded, "ts")
    return new.groupBy(F.col("ts").isNull().alias("undated")).agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- distributions


@query
def distribution_shift(spark: SparkSession, folder: str) -> DataFrame:
    """Categories and lifecycles of the parts against specifications: one that holds nearly, and some that do not."""
    rows = parts(spark, folder).where("category <> 'BOGUS'")
    wanted = {
        "near": ("lifecycle_status", {"ACTIVE": 0.85, "NEW": 0.1, "EOL": 0.05}),
        "synthetic": ("category", {"ELECTRICAL": 0.35, "MECHANICAL": 0.35, "RAW_MATERIAL": 0.2, "OTHER": 0.1}),
        "two_of_three": ("lifecycle_status", {"ACTIVE": 0.9, "NEW": 0.1}),
    }
    frames = [
        distributions.chi_square(rows, column, shares).withColumn("specification", F.lit(name))
        for name, (column, shares) in wanted.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, frames), "statistic", "p_value")


@query
def run_shift(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the line items that are alike, and two that are not: distance of their prices and quantities."""
    items = table(spark, folder, "lineitem")
    cases = {
        "alike": ("l_quantity", F.col("l_suppkey") % 2 == 0),
        "shifted": ("l_extendedprice", F.col("l_quantity") > 25),
        "nearly": ("l_extendedprice", F.col("l_partkey") % 3 == 0),
    }
    frames = [
        distributions.two_samples(items, number, first).withColumn("case", F.lit(name))
        for name, (number, first) in cases.items()
    ]
    return _rounded(reduce(DataFrame.unionByName, frames), "distance", "p_value")


# ---------------------------------------------------------------- profiles that merge


_LINES = sketches.Wanted(distinct=("l_orderkey", "l_partkey"), numbers=("l_extendedprice",), values=("l_returnflag", "l_quantity"))


def _stored_profiles(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Line items by supplier's remainder (for a tenant) and month, and their profiles as stored and read back."""
    items = table(spark, folder, "lineitem").withColumns(
        {"tenant": F.pmod("l_suppkey", F.lit(4)).cast("int"), "month": F.date_format("l_shipdate", "yyyy-MM")}
    )
    path = fresh_folder(spark, "profiles")
    made = sketches.sketch_profile(items, ["tenant", "month"], _LINES)
    for _ in range(2):  # a month that is profiled again takes the place of what was there
        sketches.store_profiles(made, path, ("month",))
    return items, spark.read.parquet(path)


@query
def sketch_surplus(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated order and part numbers of each tenant over all months, from stored sketches; beside them the exact counts."""
    items, stored = _stored_profiles(spark, folder)
    exact = items.groupBy("tenant").agg(
        F.count("*").alias("lines"), F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )
    merged = sketches.merge_profiles(stored, _LINES, ["tenant"])
    once = sketches.sketch_profile(items, ["tenant"], _LINES).select(
        "tenant", sketches.distinct_estimate("l_orderkey").alias("orders_once"), sketches.distinct_estimate("l_partkey").alias("parts_once")
    )
    told = merged.select(
        "tenant",
        sketches.surplus_estimate("l_orderkey").alias("repeated_orders"),
        sketches.distinct_estimate("l_orderkey").alias("orders_merged"),
        sketches.distinct_estimate("l_partkey").alias("parts_merged"),
    )
    both = exact.join(told, "tenant").join(once, "tenant")
    surplus = F.col("lines") - F.col("orders")
    return both.select(
        "tenant",
        "lines",
        surplus.alias("surplus"),
        (F.abs(F.col("repeated_orders") - surplus) <= F.col("orders") * sketches.DISTINCT_ERROR).alias("orders_within_error"),
        (F.abs(F.col("parts_merged") - F.col("parts")) <= F.col("parts") * sketches.DISTINCT_ERROR).alias("parts_within_error"),
        ((F.col("orders_merged") == F.col("orders_once")) & (F.col("parts_merged") == F.col("parts_once"))).alias("as_one_pass"),
    )


@query
def sketch_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Prices at some ranks over all months from stored sketches: their true rank is within the stated error."""
    items, stored = _stored_profiles(spark, folder)
    ranks = (0.01, 0.25, 0.5, 0.75, 0.99)
    merged = sketches.merge_profiles(stored, _LINES)
    found = merged.select(sketches.quantile_estimates("l_extendedprice", ranks).alias("found")).scalar()
    below = [F.avg((F.col("l_extendedprice") <= F.element_at(F.col("found"), at)).cast("double")) for at in range(1, len(ranks) + 1)]
    rank = items.withColumn("found", found).agg(F.count("*").alias("lines"), F.array(*below).alias("ranks"))
    told = rank.select("lines", F.posexplode("ranks").alias("at", "true_rank"))
    wanted = F.element_at(F.array(*[F.lit(one) for one in ranks]), F.col("at") + 1)
    return told.select("lines", wanted.alias("rank"), (F.abs(F.col("true_rank") - wanted) <= sketches.RANK_ERROR).alias("within_error"))


@query
def sketch_values(spark: SparkSession, folder: str) -> DataFrame:
    """Frequencies of values by tenant from the sketches of all months; so few values are counted exactly."""
    _, stored = _stored_profiles(spark, folder)
    merged = sketches.merge_profiles(stored, _LINES, ["tenant"])
    frames = [
        sketches.frequent_values(merged, name, 60, ["tenant"]).select(
            "tenant", F.lit(name).alias("column"), F.col(name).alias("value"), "rows"
        )
        for name in _LINES.values
    ]
    return frames[0].unionByName(frames[1])


# ---------------------------------------------------------------- every rule


@query
def supplier_every_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with faults for the rules that the mapped table never breaks."""
    k = "bigint(substr(supplier_id, 2))"
    faults = {
        "supplier_id": f"CASE WHEN {k} % 9 <> 4 THEN supplier_id END",
        "tenant_id": f"CASE WHEN {k} % 8 <> 3 THEN tenant_id END",
        "defect_rate_ppm": f"CASE WHEN {k} % 7 = 2 THEN -1 ELSE defect_rate_ppm END",
        "financial_risk_tier": f"CASE WHEN {k} % 6 = 5 THEN 'NONE' ELSE financial_risk_tier END",
    }
    rows = suppliers(spark, folder)
    broken = rows.selectExpr(*[f"{faults.get(name, name)} AS {name}" for name in rows.columns])
    return metrics.violation_counts(rules.tag_suppliers(broken))


@query
def part_every_rule(spark: SparkSession, folder: str) -> DataFrame:
    """The same for parts."""
    k = "bigint(substr(part_id, 2))"
    faults = {
        "part_id": f"CASE WHEN {k} % 9 <> 4 THEN part_id END",
        "tenant_id": f"CASE WHEN {k} % 8 <> 3 THEN tenant_id END",
        "part_number": f"CASE WHEN {k} % 7 <> 2 THEN part_number END",
        "category": f"CASE WHEN {k} % 11 <> 5 THEN category END",
        "moq": f"CASE WHEN {k} % 13 = 1 THEN -5 ELSE moq END",
        "lead_time_days_avg": f"CASE WHEN {k} % 10 = 7 THEN -1 ELSE lead_time_days_avg END",
        "lifecycle_status": f"CASE WHEN {k} % 12 = 6 THEN 'OLD' ELSE lifecycle_status END",
    }
    rows = parts(spark, folder)
    broken = rows.selectExpr(*[f"{faults.get(name, name)} AS {name}" for name in rows.columns])
    return metrics.violation_counts(references.tag_parts(broken, _valid_ids(spark, folder)))


@query
def part_strict_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Parts whose supplier lists came as arrays, a third of them empty, where the landing format wants text."""
    k = F.substring("part_id", 2, 20).cast("long")
    listed = F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(L.text_to_list(F.col("qualified_supplier_ids")))
    rows = parts(spark, folder).withColumn("qualified_supplier_ids", listed)
    return metrics.violation_counts(references.tag_parts(rows, _valid_ids(spark, folder), strict_text=True))
