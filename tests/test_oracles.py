"""Every registered query against DuckDB on the smallest data."""

import duckdb
import pytest
from conftest import rows

import checks

SF = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "part", "events")
QUERIES, ORACLES = checks.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def by_name(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr([row[i] for i in order]) for row in data))


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    expected = by_name([c[0] for c in result.description], result.fetchall())
    assert by_name(df.columns, rows(df)) == expected
