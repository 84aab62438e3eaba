import duckdb
import pytest

import __spark_entry__ as registered
from check_queries import TABLES, compare
from rowlake.llm.queries import QUERIES


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_against_sql(spark, sf_dir, name):
    folder = sf_dir.replace("0.001", "0.01")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    ok, note = compare(spark, connection, name, folder)
    assert ok, note


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if not sql))
def test_query_has_a_row_per_document(spark, sf_dir, name):
    found = QUERIES[name][0](spark, sf_dir)
    assert found.count() == 200 and found.select("doc_id").distinct().count() == 200
