"""Each named query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tidewrack.registry.queries import QUERIES
from compare import compare, duckdb_connection


@pytest.fixture(scope="module")
def connection(sf):
    return duckdb_connection(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, sf, name):
    rows, problem = compare(spark, connection, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert not problem
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["metric_date", "transactions", "volume", "fraud"]
    first = frame.orderBy("metric_date").first()
    assert (str(first["metric_date"]), first["transactions"], str(first["volume"])) == ("2023-12-31", 1, "64.24")
