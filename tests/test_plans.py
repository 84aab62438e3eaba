"""What the physical plans must and must not hold."""

import json
import re

import pyarrow as pa
from pyspark.sql import functions as F

from rowlake.operators import profile
from rowlake.plans import bulk, fanout
from rowlake.plans.fanout import staged_rows
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed
from rowlake.sources.envelope import decode_envelope
from rowlake.sources.messages import replay_batch, within_ranges


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_sort_in_the_profile(spark, sf_dir):
    rows = routed(fx.logged(spark, fx.orders_messages(spark, sf_dir)))
    for packed in (True, False):
        text = plan(profile.profile_columns(rows, packed=packed))
        assert "Python" not in text and "SortMergeJoin" not in text
        assert "HashAggregate" in text
        # The pass over the entries is a hash aggregation; only its small result may be sorted.
        below_first_exchange = text.split("Exchange")[-1]
        assert "SortAggregate" not in below_first_exchange and "Sort [" not in below_first_exchange


def test_profile_reads_only_what_it_needs(spark, sf_dir):
    text = plan(profile.materialized_columns(routed(fx.logged(spark, fx.orders_messages(spark, sf_dir)))))
    assert "ReadSchema: struct<value:string>" in text


def test_drain_predicate_reaches_the_scan(spark, sf_dir):
    log = replay_batch(spark, fx.written_log(spark, fx.orders_messages(spark, sf_dir)))
    text = plan(decode_envelope(within_ranges(log, {0: (2, 5), 1: (0, 3)})))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThanOrEqual(offset,2)" in pushed and "EqualTo(partition,1)" in pushed


def test_a_staged_table_reads_its_own_directory(spark, sf_dir):
    staged, release = staged_rows(routed(fx.sales_messages(spark, sf_dir)), "table")
    text = plan(staged.where(F.col("table_name") == "customer"))
    assert re.search(r"PartitionFilters: \[.*table_name.*customer", text)
    release()


def test_scan_prunes_and_pushes(spark, lake, sf_dir):
    lake.append("orders", fx.table(spark, sf_dir, "orders"))
    text = plan(lake.scan("orders").where("o_orderkey = 7").select("o_orderstatus"))
    assert "EqualTo(o_orderkey,7)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_line_items_are_grouped_and_staged_without_a_shuffle(spark, sf_dir, lake, monkeypatch):
    plan = fx.lineitem_messages(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    staged, release = fanout.staged_rows(routed(fx.lineitem_messages(spark, sf_dir)), "table")
    assert staged.count() == fx.table(spark, sf_dir, "lineitem").count()
    release()


def test_twenty_rows_a_message_across_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in ([3] * n, list(range(first, first + n)))], ["p", "r"]) for first, n in ((0, 7), (7, 30), (37, 0), (37, 28))]
    out = [(r["p"], r["grp"], r["data"]) for b in fx._in_twenties(iter(batches)) for r in b.to_pylist()]
    assert out == [(3, i, list(range(20 * i, min(20 * i + 20, 65)))) for i in range(4)]
    assert list(fx._in_twenties(iter([]))) == []


def test_a_log_has_more_files_as_its_tables_grow(spark, sf_dir, monkeypatch):
    log = fx.orders_messages(spark, sf_dir)
    assert fx.dealt(spark, sf_dir, log, ("orders",), 6).rdd.getNumPartitions() == 6
    monkeypatch.setattr(fx, "BYTES_PER_FILE", 1000)
    assert fx.dealt(spark, sf_dir, log, ("orders",), 6).rdd.getNumPartitions() > 6


def test_many_tables_of_their_own_columns(spark, lake):
    values = [json.dumps({"filename": f"t{i}.csv", "data": [{f"c{i}": str(i)}]}) for i in range(20)]
    log = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "partition int, offset bigint, value string")
    written = bulk.bulk_ingest(log, lake, "s", staging="table").tables
    assert [w.rows for w in written] == [1] * 20
    assert all(lake.scan(f"t{i}").select(f"c{i}").collect()[0][0] == str(i) for i in range(20))
