"""Files, tables, the whole job and the stream."""

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clearlot import contracts as C
from clearlot.operators import checks, clean, curate, references, rules, synth
from clearlot.plans import curation, dataset
from clearlot.plans.tables import landed_parts, landed_suppliers, parts, suppliers
from clearlot.session import fresh_folder, shared_folder, staged
from clearlot.sources import exports, landing, tables
from clearlot.streaming.incremental import load_new_files, watch_folder

AS_OF = "2025-01-01 00:00:00"


@pytest.fixture
def place(spark):
    return fresh_folder(spark, "test")


def database(spark, place):
    name = f"db_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}/db'")
    return name


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert fresh_folder(spark, "a") != fresh_folder(spark, "a")


def test_staged_keeps_rows_and_types(spark):
    frame = spark.createDataFrame([(1, True, ["a"]), (2, False, [])], "id int, ok boolean, l array<string>")
    kept = staged(frame, "test", ("ok",))
    assert rows_of(kept, "id", "ok", "l") == [(1, True, ["a"]), (2, False, [])]
    assert dict(kept.dtypes) == dict(frame.dtypes)
    assert staged(frame.where("id > 5"), "test").count() == 0


def test_csv_round_trip(spark, place):
    rows = [
        ("p1", 'say "hi", twice', ["a", "b"], None),
        ("p2", "  edge  ", [], "CLASS_1"),
        ("p3", "", None, ""),
        ("p4", "back\\slash", ["c"], "x,y"),
    ]
    frame = spark.createDataFrame(
        rows, "part_id string, description string, bom_compatibility array<string>, hazard_class string"
    )
    exports.write_csv_flat(frame, f"{place}/parts.csv", C.PARTS)
    back = landing.read_csv(spark, f"{place}/parts.csv", C.PARTS)
    assert back.columns == C.columns(C.PARTS)
    assert rows_of(back, "part_id", "description", "bom_compatibility", "hazard_class", "uom") == [
        ("p1", 'say "hi", twice', "a,b", "", ""),
        ("p2", "  edge  ", "", "CLASS_1", ""),
        ("p3", "", "", "", ""),
        ("p4", "back\\slash", "c", "x,y", ""),
    ]


def test_csv_is_readable_by_others(spark, place):
    import csv
    import glob

    frame = spark.createDataFrame([("p1", 'a "b", c')], "part_id string, description string").coalesce(1)
    exports.write_csv_flat(frame, f"{place}/parts.csv", C.PARTS)
    with open(glob.glob(f"{place.removeprefix('file:')}/parts.csv/part-*.csv")[0], newline="", encoding="utf-8") as file:
        header, row = list(csv.reader(file))
    assert header == C.columns(C.PARTS) and row[0] == "p1" and row[3] == 'a "b", c' and row[6] == ""


def test_parquet_shapes(spark, place):
    made = synth.synth_suppliers(spark.range(10), as_of=AS_OF)
    exports.write_parquet_flat(made, f"{place}/split")
    split = spark.read.parquet(f"{place}/split")
    assert "geo_coords" not in split.columns and {"geo_lat", "geo_lon"} <= set(split.columns)
    exports.write_parquet_json_geo(made, f"{place}/json")
    landed = spark.read.parquet(f"{place}/json")
    assert dict(landed.dtypes)["geo_coords"] == dict(landed.dtypes)["certifications"] == "string"
    expected = rows_of(made, "supplier_id", "geo_coords.lat", "geo_coords.lon")
    assert rows_of(clean.repair_geo(landed), "supplier_id", "geo_coords.lat", "geo_coords.lon") == expected
    assert rows_of(clean.repair_geo(split), "supplier_id", "geo_coords.lat", "geo_coords.lon") == expected


def test_empty_export_writes_nothing(spark, place):
    empty = synth.synth_suppliers(spark.range(0))
    assert exports.write_parquet_flat(empty, f"{place}/x") is False
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{place}/x")


def test_csv_chunks(spark, place):
    exports.write_csv_chunked(spark.range(100).coalesce(1), f"{place}/x", rows_per_file=30)
    assert len(spark.read.text(f"{place}/x").inputFiles()) == 4


def test_sql_staging(spark):
    row = ("p1", "t", "INVALID_UOM", ["a"], [])
    frame = spark.createDataFrame(
        [row], "part_id string, tenant_id string, uom string, qualified_supplier_ids array<string>, compliance_flags array<string>"
    )
    whole = frame.select(
        *[F.col(name) if name in frame.columns else F.lit(None).cast("string").alias(name) for name in C.columns(C.PARTS)]
    )
    found = exports.stage_for_sql(whole, C.PARTS)
    assert found.columns == C.sql_columns(C.PARTS)
    assert rows_of(found, "uom", "qualified_supplier_ids", "compliance_flags") == [("INVALID", '["a"]', None)]
    assert C.sql_columns(C.SUPPLIERS)[:3] == ["supplier_id", "tenant_id", "supplier_code"]


def test_upload_layout(spark, place):
    spark.range(2).write.parquet(f"{place}/tenant_a/2024-01-31/20240131_060000/suppliers.parquet")
    found = landing.with_upload_lineage(spark.read.parquet(f"{place}/tenant_a/2024-01-31/*/suppliers*"))
    assert rows_of(found.distinct(), "landing_tenant", "landing_date", "landing_run_id", "landing_entity") == [
        ("tenant_a", "2024-01-31", "20240131_060000", "suppliers")
    ] * 2


def test_curated_table(spark, place, folder):
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.s", f"{place}/s")
    assert tables.create_curated_table(spark, C.SUPPLIERS, name, f"{place}/s") == name
    assert spark.table(name).schema.simpleString().count("struct<lat:double,lon:double>") == 1
    assert len(spark.table(name).columns) == 39 and tables.has_struct_column(spark, name)
    rows = curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS)
    wanted = rows.count()
    tables.append_rows(rows, C.SUPPLIERS, name)
    tables.append_rows(rows, C.SUPPLIERS, name)
    assert tables.row_count(spark, name) == 2 * wanted
    tables.append_rows(rows, C.SUPPLIERS, name, replace=True)
    assert tables.row_count(spark, name) == wanted
    # Only the tenants that are written, or named, are replaced.
    one = rows.where("tenant_id = 'tenant_0'")
    tables.append_rows(one.limit(0), C.SUPPLIERS, name, replace=True)
    assert tables.row_count(spark, name) == wanted
    tables.append_rows(one, C.SUPPLIERS, name)
    tables.append_rows(one, C.SUPPLIERS, name, replace=True)
    assert tables.row_count(spark, name) == wanted
    pruned = plan_of(spark.table(name).where("tenant_key = 't_tenant_0'"))
    assert "PartitionFilters: [isnotnull(tenant_key" in pruned
    before = rows_of(spark.table(name), "supplier_id", "risk_score")
    tables.compact_partitions(spark, name, C.SUPPLIERS, {"tenant_key": "t_tenant_0"})
    assert rows_of(spark.table(name), "supplier_id", "risk_score") == before
    with pytest.raises(ValueError, match="country"):
        tables.compact_partitions(spark, name, C.SUPPLIERS, {"country": "CN"})
    gone = spark.createDataFrame([("t_tenant_0", C.UNDATED)], "tenant_key string, landing_date string")
    tables.append_rows(one.limit(0), C.SUPPLIERS, name, replace=True, replaced=gone)
    assert rows_of(spark.table(name), "supplier_id") == rows_of(rows.where("tenant_id <> 'tenant_0'"), "supplier_id")


def test_empty_tenant_is_kept(spark, place, folder):
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.e", f"{place}/e", buckets=2)
    rows = curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS)
    rows = staged(rows.withColumn("tenant_id", F.lit("")), "rows")
    tables.append_rows(rows, C.SUPPLIERS, name)
    tables.upsert_rows(rows.limit(1).withColumn("supplier_id", F.lit("new")), C.SUPPLIERS, name)
    assert spark.table(name).where("tenant_id = ''").count() == rows.count() + 1


def test_rows_per_file(spark, place, folder):
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.f", f"{place}/f", buckets=0)
    rows = curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS)
    tables.append_rows(rows.withColumn("tenant_id", F.lit("one")), C.SUPPLIERS, name, rows_per_file=2)
    assert len(spark.table(name).inputFiles()) >= -(-rows.count() // 2)


def test_parts_table_layout(spark, place):
    name = tables.create_curated_table(spark, C.PARTS, f"{database(spark, place)}.p", f"{place}/p")
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "16" and described["Bucket Columns"] == "[`part_id`]"
    assert described["unit_cost"] == "decimal(18,6)" and described["last_price_change"] == "string"


@pytest.mark.parametrize("tenant", ["tenant_a", "tenant a+b", "caf\u00e9 100%"])
def test_lineage_of_odd_tenant_names(spark, place, tenant):
    spark.range(3).write.parquet(landing.run_folder(place, tenant, C.PARTS, "2024-01-31", "20240131_060000"))
    found = landing.with_lineage(landing.read_landing(spark, place, "*", C.PARTS, "2024-01-31"))
    lineage = ("landing_tenant", "landing_entity", "landing_date", "landing_run_id")
    assert rows_of(found.select(*lineage).distinct()) == [(tenant, "parts", "2024-01-31", "20240131_060000")]


def test_columns_only_some_runs_have(spark, place):
    for run_id, frame in (("20240131_060000", spark.range(2)), ("20240131_180000", spark.range(3).withColumn("new", F.lit("x")))):
        frame.write.parquet(landing.run_folder(place, "t", C.PARTS, "2024-01-31", run_id))
    merged = landing.read_landing(spark, place, "t", C.PARTS, "2024-01-31", merge_schema=True)
    assert rows_of(merged.groupBy("new").count()) == [("x", 3), (None, 2)]
    unknown = checks.drift_report(merged, C.PARTS).where("departure = 'unknown'")
    assert rows_of(unknown, "field", "filled") == [("id", 5), ("new", 3)]


def test_bucket_count(spark, place, folder):
    db = database(spark, place)
    rows = curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS)
    for buckets, expected in ((0, 1), (4, 4)):
        name = tables.create_curated_table(spark, C.SUPPLIERS, f"{db}.b{buckets}", f"{place}/b{buckets}", buckets=buckets)
        assert tables.bucket_count(spark, name) == expected
        tables.append_rows(rows, C.SUPPLIERS, name)
        assert tables.row_count(spark, name) == rows.count()


def test_table_upsert_rewrites_only_touched_partitions(spark, place, folder):
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.u", f"{place}/u", buckets=2)
    rows = staged(curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS), "rows")
    tables.append_rows(rows, C.SUPPLIERS, name)
    before = set(spark.table(name).inputFiles())
    chosen = rows.orderBy("supplier_id").first()
    # The batch names another tenant, but the tenant is no updatable column: the row stays where it is.
    batch = rows.where(F.col("supplier_id") == chosen["supplier_id"]).withColumns(
        {"risk_score": F.lit(1.0), "tenant_id": F.lit("elsewhere"), "city": F.lit("moved")}
    )
    for _ in range(2):
        tables.upsert_rows(batch, C.SUPPLIERS, name)
    after = spark.table(name)
    assert after.count() == rows.count()
    changed = after.where(F.col("supplier_id") == chosen["supplier_id"]).first()
    assert (changed["risk_score"], changed["tenant_id"], changed["city"]) == (1.0, chosen["tenant_id"], chosen["city"])
    kept = before & set(after.inputFiles())
    assert kept == {path for path in before if f"tenant_key=t_{chosen['tenant_id']}/" not in path}


def _scanned(frame):
    """Rows that the scans of a frame hand on, after files, row groups and pages are ruled out."""
    frame.collect()
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(at) for at in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return total


def test_few_keys_are_found_without_reading_the_table(spark, place, folder):
    """A hundred files and more: the lookup of an upsert reads a small part of their rows."""
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.k", f"{place}/k", buckets=4)
    made = synth.synth_suppliers(spark.range(4_000), as_of=AS_OF)
    rows = staged(curate.curated_rows(rules.tag_suppliers(made), C.SUPPLIERS), "rows")
    dated = rows.withColumn("landing_date", F.concat(F.lit("2024-01-"), F.lpad(F.pmod(F.xxhash64("supplier_id"), F.lit(28)).cast("string"), 2, "0")))
    tables.append_rows(dated, C.SUPPLIERS, name)
    files = len(spark.table(name).inputFiles())
    keys = [row[0] for row in rows.select("supplier_id").limit(2).collect()]
    found = tables.rows_of_keys(spark, name, "supplier_id", keys).select("tenant_key", "landing_date")
    whole = spark.table(name).select("supplier_id")
    assert files >= 100 and found.count() == 2
    assert _scanned(whole) == rows.count() and 0 < _scanned(found) * 10 <= rows.count()
    assert tables.rows_of_keys(spark, name, "supplier_id", ["absent"]).count() == 0
    batch = dated.where(F.col("supplier_id").isin(keys)).withColumn("risk_score", F.lit(1.0))
    for limit in (tables.POINT_KEYS, 1):
        tables.POINT_KEYS, kept = limit, tables.POINT_KEYS
        try:
            tables.upsert_rows(batch.withColumn("risk_score", F.lit(float(limit))), C.SUPPLIERS, name)
        finally:
            tables.POINT_KEYS = kept
        assert spark.table(name).where(F.col("risk_score") == float(limit)).count() >= 2
        assert spark.table(name).count() == rows.count()


def test_only_partitions_in_many_files_are_compacted(spark, place, folder):
    name = tables.create_curated_table(spark, C.SUPPLIERS, f"{database(spark, place)}.z", f"{place}/z", buckets=2)
    rows = staged(curate.curated_rows(rules.tag_suppliers(suppliers(spark, folder)), C.SUPPLIERS), "rows")
    tables.append_rows(rows, C.SUPPLIERS, name)
    one = rows.where("tenant_id = 'tenant_1'")
    for _ in range(3):
        tables.append_rows(one, C.SUPPLIERS, name)
    before, content = set(spark.table(name).inputFiles()), rows_of(spark.table(name), "supplier_id", "risk_score")
    done = tables.compact_partitions(spark, name, C.SUPPLIERS).collect()
    after = set(spark.table(name).inputFiles())
    assert [row["tenant_key"] for row in done] == ["t_tenant_1"] and done[0]["before"] >= 4 and done[0]["after"] <= 2
    assert {path for path in before if "tenant_key=t_tenant_1/" not in path} == {path for path in after if "tenant_key=t_tenant_1/" not in path}
    assert len([path for path in after if "tenant_key=t_tenant_1/" in path]) == done[0]["after"]
    assert rows_of(spark.table(name), "supplier_id", "risk_score") == content
    assert tables.compact_partitions(spark, name, C.SUPPLIERS).collect() == []
    assert set(spark.table(name).inputFiles()) == after
    # a small target splits a bucket among files again, and does not come back to it
    small = min(row["bytes"] for row in tables.file_sizes(spark, name, C.SUPPLIERS).collect()) // 3
    tables.append_rows(one, C.SUPPLIERS, name)
    assert tables.compact_partitions(spark, name, C.SUPPLIERS, target_bytes=small).collect() == []


def test_stale_partitions_go_after_new_rows_are_there(spark, place, folder, monkeypatch):
    name = tables.create_curated_table(spark, C.PARTS, f"{database(spark, place)}.y", f"{place}/y", buckets=0)
    made = synth.synth_parts(spark.range(300), 40, as_of=AS_OF)
    ids = synth.synth_suppliers(spark.range(40), as_of=AS_OF).select("supplier_id")
    rows = staged(curate.curated_rows(references.tag_parts(made, ids), C.PARTS).withColumn("tenant_id", F.lit("o'b\\c d")), "rows")
    tables.append_rows(rows, C.PARTS, name)
    assert len(tables._partitions(spark, name)) == 4
    less = rows.where("category <> 'ELECTRICAL'")
    seen = []
    drop = tables._drop_partitions
    monkeypatch.setattr(tables, "_drop_partitions", lambda *args: (seen.append(tables.row_count(spark, name)), drop(*args)))
    tables.append_rows(less, C.PARTS, name, replace=True)
    assert seen == [rows.count()] and tables.row_count(spark, name) == less.count() < rows.count()
    assert len(tables._partitions(spark, name)) == 3
    tables.append_rows(rows.where("category = 'ELECTRICAL'"), C.PARTS, name)
    assert tables.row_count(spark, name) == rows.count()


def test_buckets_follow_the_load(spark, folder):
    assert [tables.buckets_for(size) for size in (0, 1 << 31, (1 << 31) + 1, 10**12, 10**20)] == [16, 16, 32, 8_192, 65_536]
    assert tables.stored_bytes(staged(spark.range(1000), "size")) > 1000


def land(spark, root, folder, with_parts=True):
    path = landing.run_folder(root, "tenant_a", C.SUPPLIERS, "2024-01-31", "20240131_060000")
    landed_suppliers(spark, folder).write.parquet(path)
    if with_parts:
        path = landing.run_folder(root, "tenant_a", C.PARTS, "2024-01-31", "20240131_060000")
        landed_parts(spark, folder).write.parquet(path)


def test_job_without_suppliers_does_nothing(spark, place):
    assert curation.run(spark, place, "tenant_a", "2024-01-31") is None


def test_job_without_parts(spark, place, folder):
    land(spark, place, folder, with_parts=False)
    done = curation.run(spark, place, "tenant_a", "2024-01-31", database(spark, place), f"{place}/curated")
    assert [row["entity"] for row in done.collect()] == ["suppliers", "overall"]


def test_job_reruns(spark, place, folder):
    land(spark, place, folder)
    name = database(spark, place)
    targets = dict(database=name, location=f"{place}/curated", quarantine=f"{place}/quarantine", replace=True)
    reports = [rows_of(curation.run(spark, place, "tenant_a", "2024-01-31", **targets)) for _ in range(2)]
    assert reports[0] == reports[1]
    counts = {row[0]: row for row in reports[0]}
    for entity in C.ENTITIES:
        kept = spark.table(f"{name}.{C.CURATED_TABLE[entity]}")
        refused = spark.read.parquet(f"{place}/quarantine/{entity}")
        assert kept.count() == counts[entity][2]
        assert kept.count() + refused.count() == counts[entity][1]
        assert refused.where(F.size("dq_violations") == 0).count() == 0
        assert kept.select("dq_timestamp").distinct().count() <= 1


def test_report_of_a_staged_job_reads_nothing(spark, place, folder):
    ids = suppliers(spark, folder)
    tagged = curation.tag_both(ids, parts(spark, folder))
    lazy = curation.tag_both(ids, parts(spark, folder), stage=False)
    spark.sparkContext.setJobGroup("report", "report")
    told = rows_of(curation.report(tagged))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert told == rows_of(curation.report(lazy)) and len(told) == 3 and not lazy.counts
    plan = plan_of(curation.report(tagged))
    assert "Scan parquet" not in plan and "FileScan" not in plan
    none = curation.tag_both(ids.where("false"), None)
    assert none.counts == {C.SUPPLIERS: (0, 0)}


def test_one_failing_tenant_leaves_the_others_stored(spark, place, folder):
    for tenant in ("one", "two", "three", "four"):
        path = landing.run_folder(place, tenant, C.SUPPLIERS, "2024-01-31", "20240131_060000")
        rows = landed_suppliers(spark, folder).withColumn("supplier_code", F.lit(tenant))  # exchanged with tenant_id
        (rows.drop("supplier_id") if tenant == "two" else rows).write.parquet(path)
    path = landing.run_folder(place, "one", C.PARTS, "2024-01-31", "20240131_060000")
    landed_parts(spark, folder).withColumn("tenant_id", F.lit("one")).write.parquet(path)
    assert landing.landed_tenants(spark, place, C.SUPPLIERS, "2024-01-31") == ["four", "one", "three", "two"]
    name = database(spark, place)
    targets = dict(database=name, location=f"{place}/curated", quarantine=f"{place}/quarantine")
    for replace, times in ((False, 1), (False, 2), (True, 1)):
        told = curation.run_tenants(spark, place, "2024-01-31", jobs=3, replace=replace, **targets).collect()
        failed = [row for row in told if row["error"]]
        assert [row["tenant"] for row in failed] == ["two"] and "supplier_id" in failed[0]["error"]
        done = {(row["tenant"], row["entity"]): row for row in told if not row["error"]}
        assert set(done) == {("one", "suppliers"), ("three", "suppliers"), ("four", "suppliers"), ("one", "parts")}
        assert all(row["records_per_second"] > 0 and row["seconds"] > 0 for row in done.values())
        for entity in C.ENTITIES:
            kept = spark.table(f"{name}.{C.CURATED_TABLE[entity]}").count()
            assert kept == times * sum(row["valid"] for (_, kind), row in done.items() if kind == entity)
            refused = spark.read.parquet(f"{place}/quarantine/{entity}").count()
            assert kept + refused == times * sum(row["total"] for (_, kind), row in done.items() if kind == entity)
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_required_source(spark, place):
    missing = lambda: landing.read_landing(spark, place, "t", C.PARTS, "2024-01-31")
    assert landing.read_or_none(missing) is None
    with pytest.raises(AnalysisException):
        landing.read_or_none(missing, required=True)


def test_dataset_export(spark, place):
    made = dataset.export_dataset(dataset.make_dataset(spark, 50, 60, dirty_rate=0.1, as_of=AS_OF), place)
    assert (made.suppliers.count(), made.parts.count()) == (50, 60)
    assert landing.read_csv(spark, f"{place}/parts.csv", C.PARTS).count() == 60
    assert spark.read.parquet(f"{place}/sql/suppliers").columns == C.sql_columns(C.SUPPLIERS)
    clean_data = dataset.make_dataset(spark, 50, 60, dirty_rate=0.0, as_of=AS_OF)
    assert rules.tag_suppliers(clean_data.suppliers).where("NOT is_valid").count() == 0


def test_stream_loads_each_file_once(spark, place):
    schema = spark.range(1).schema
    for run in range(2):
        spark.range(run * 10, run * 10 + 10).write.mode("append").parquet(f"{place}/in")
        stream = watch_folder(spark, f"{place}/in", schema, files_per_batch=3)
        load_new_files(stream, f"{place}/out", f"{place}/progress", lambda batch: batch.where("id % 2 = 0"))
        loaded = spark.read.schema(schema).parquet(f"{place}/out/batch=*")
        assert rows_of(loaded) == sorted(((n,) for n in range(0, run * 10 + 10, 2)), key=repr)


def test_contract_checks(spark, folder):
    made = synth.synth_suppliers(spark.range(50), as_of=AS_OF)
    assert rows_of(checks.field_coverage(made, C.SUPPLIERS)) == [(33, 33, "", "")]
    assert rows_of(checks.verdict(checks.contract_violations(made, C.SUPPLIERS))) == [(True, 0)]
    flat = exports.flat_split_geo(made).withColumn("risk_score", F.col("risk_score").cast("string"))
    found = {row["check"]: row["rows"] for row in checks.contract_violations(flat, C.SUPPLIERS).collect()}
    assert found["geo_coords missing"] == found["geo_coords is split"] == found["risk_score has type string"] == 1
    assert rows_of(checks.verdict(checks.contract_violations(flat, C.SUPPLIERS)), "compliant") == [(False,)]
    typed = clean.typed_view(made, C.SUPPLIERS)
    assert checks.drift_report(typed, C.SUPPLIERS).count() == 0
    assert typed.schema.simpleString() == C.contract_schema(C.SUPPLIERS).simpleString()
    assert C.contract_schema(C.SUPPLIERS)["risk_score"].metadata == {"required": False, "min": 0, "max": 100}


def test_constraints(spark):
    rows = [("a", "t" * 51, "n"), ("a", None, None), (None, "t", "n")]
    frame = spark.createDataFrame(rows, "supplier_id string, tenant_id string, legal_name string")
    found = {row["constraint"]: row["rows"] for row in checks.constraint_report(frame, C.SUPPLIERS).collect()}
    assert found == {
        "supplier_id is NULL": 1, "tenant_id is NULL": 1, "legal_name is NULL": 1, "supplier_id longer than 26": 0,
        "tenant_id longer than 50": 1, "legal_name longer than 255": 0, "supplier_id repeated": 1,
    }


def test_scans_read_only_what_they_need(spark, folder):
    """Columns nobody asks for are not read, and no Python runs."""
    counted = suppliers(spark, folder).groupBy("tenant_id").count()
    plan = plan_of(counted)
    assert "ReadSchema: struct<s_nationkey:int>" in plan
    assert "Python" not in plan
    assert "PushedFilters: [IsNotNull(n_nationkey)]" in plan
    assert "p_retailprice" not in plan_of(parts(spark, folder).select("part_id"))
