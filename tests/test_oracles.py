"""Every registered query against its SQL on the same tables."""

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from tidemark.registry import oracles, queries

QUERIES, SQL = queries.QUERIES, oracles.oracle_sql()
TABLES = ["customer", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    return connection


def _normal(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(_normal(row[c]) for c in columns) for row in frame.collect()]
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(_normal(row[i]) for i in order) for row in result.fetchall()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    if name != "param_scan":
        assert got


def test_entry_returns_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "report_date"
    assert frame.count() > 0
