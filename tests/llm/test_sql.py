"""The corpus queries that SQL can state, against DuckDB."""

import duckdb
import pytest

from clearlot.llm.oracle import ORACLE
from clearlot.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, database, folder, name):
    frame = QUERIES[name](spark, folder)
    found = database.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in found.description}
    assert {column: TYPE_NAMES[kind] for column, kind in frame.dtypes} == types
    order = sorted(types)
    position = [list(types).index(column) for column in order]
    expected = sorted((tuple(row[at] for at in position) for row in found.fetchall()), key=repr)
    assert sorted((tuple(row) for row in frame.select(*order).collect()), key=repr) == expected


def test_sql_states_queries():
    assert set(ORACLE) <= set(QUERIES)
