"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the number of cores. ``records_per_second`` gives the
throughput of making and of curating 100 000 suppliers and 100 000 parts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from clearlot.operators.synth import FAST, ids_from_range, synth_parts, synth_suppliers
from clearlot.plans import curation, dataset
from clearlot.plans.queries import QUERIES
from clearlot.session import fresh_folder, local_session

HEADLINES = [
    "supplier_violation_profile",
    "part_violation_profile",
    "overall_pass_rate",
    "curated_parts",
    "orphan_list_members",
    "lineitem_references",
    "dedupe_latest",
    "repeated_keys",
    "duplicate_codes",
    "upsert_update",
    "upsert_ignore",
    "sql_upsert",
    "incremental_rows",
    "cast_contract_parts",
    "constraint_report_parts",
    "contract_verdict",
    "roundtrip_csv_parts",
    "overwrite_partition",
    "synth_suppliers_ranges",
    "synth_parts_references",
    "injected_profile",
    "curation_job",
]
ROWS = 100_000
AS_OF = "2024-01-31 00:00:00"


def consume(frame) -> None:
    """Compute every row and column without keeping any."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "clearlot-bench")
    consume(QUERIES["supplier_tagged"](spark, folder))  # start-up is not part of any query

    seconds = {name: timed(lambda: consume(QUERIES[name](spark, folder))) for name in HEADLINES}

    ids = ids_from_range(spark, ROWS)
    seconds["make_100k_suppliers"] = timed(lambda: consume(synth_suppliers(ids, as_of=AS_OF)))
    seconds["make_100k_parts"] = timed(lambda: consume(synth_parts(ids, ROWS, as_of=AS_OF)))
    million = ids_from_range(spark, 10 * ROWS)
    seconds["make_1m_suppliers"] = timed(lambda: consume(synth_suppliers(million, as_of=AS_OF)))
    seconds["make_1m_parts"] = timed(lambda: consume(synth_parts(million, 10 * ROWS, as_of=AS_OF)))

    place = fresh_folder(spark, "bench")
    made = dataset.make_dataset(spark, ROWS, ROWS, as_of=AS_OF, variant=FAST)
    seconds["land_100k_100k"] = timed(
        lambda: dataset.land_dataset(made, place, "tenant_a", "2024-01-31", "20240131_060000")
    )
    database = f"bench_{place.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}/db'")
    seconds["curate_100k_100k"] = timed(
        lambda: curation.run(
            spark, place, "tenant_a", "2024-01-31", database, f"{place}/curated", f"{place}/quarantine"
        ).collect()
    )
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "records_per_second": {
                    "make": round(2 * ROWS / (seconds["make_100k_suppliers"] + seconds["make_100k_parts"])),
                    "curate": round(2 * ROWS / seconds["curate_100k_100k"]),
                },
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
