"""Every registered query against its SQL over the original tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from check_queries import TABLES, compare
from rowlake.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return made


def test_names_match():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, sf_dir, name):
    ok, note = compare(spark, connection, name, sf_dir)
    assert ok, note


def test_entry(spark):
    assert registered.entry(spark).count() == 7650
