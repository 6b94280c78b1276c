"""Every query gives what its SQL gives, with the same columns and types."""

import duckdb
import pytest

import __spark_entry__ as entry_file
from clearlot.plans.oracle import ORACLE
from clearlot.plans.queries import QUERIES
from conftest import FOLDER

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, database, name):
    frame = entry_file.queries()[name](spark, FOLDER)
    found = database.execute(entry_file.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in found.description}
    assert sorted(frame.columns) == sorted(types)
    assert {column: TYPE_NAMES[kind] for column, kind in frame.dtypes} == types
    order = sorted(types)
    position = [list(types).index(column) for column in order]
    expected = sorted((tuple(row[at] for at in position) for row in found.fetchall()), key=repr)
    assert sorted((tuple(row) for row in frame.select(*order).collect()), key=repr) == expected


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLE) <= set(entry_file.oracle_sql())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


# Golden counts of violations per combination, from the mapping's description.
GOLDEN_SUPPLIERS = {
    "": 5, "MISSING_LEGAL_NAME": 1, "INVALID_ON_TIME_RATE": 1, "NEGATIVE_LEAD_TIME": 1, "INVALID_STATUS": 1,
    "INVALID_COUNTRY_CODE": 1,
}
GOLDEN_PARTS = {
    "": 33, "MISSING_DEFAULT_SUPPLIER": 1, "MISSING_DEFAULT_SUPPLIER,ORPHAN_QUALIFIED_SUPPLIER": 4,
    "ORPHAN_DEFAULT_SUPPLIER,ORPHAN_QUALIFIED_SUPPLIER": 96,
    "ORPHAN_DEFAULT_SUPPLIER,ORPHAN_QUALIFIED_SUPPLIER,INVALID_CATEGORY": 2,
    "ORPHAN_DEFAULT_SUPPLIER,ORPHAN_QUALIFIED_SUPPLIER,NEGATIVE_UNIT_COST": 2,
    "ORPHAN_QUALIFIED_SUPPLIER": 54, "ORPHAN_QUALIFIED_SUPPLIER,INVALID_CATEGORY": 2,
    "ORPHAN_QUALIFIED_SUPPLIER,NEGATIVE_UNIT_COST": 3, "NEGATIVE_UNIT_COST": 2, "INVALID_CATEGORY": 1,
}


@pytest.mark.parametrize(
    "name, golden", [("supplier_violation_profile", GOLDEN_SUPPLIERS), ("part_violation_profile", GOLDEN_PARTS)]
)
def test_golden_counts(spark, name, golden):
    found = entry_file.queries()[name](spark, FOLDER).collect()
    assert {row["violations"]: row["rows"] for row in found} == golden
