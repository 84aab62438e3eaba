import pytest
from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.operators.shape import route_physical, route_typed
from rowlake.plans import bulk
from rowlake.queries import fixtures as fx
from rowlake.queries.rdbms import namespace
from rowlake.sources import rdbms as rd
from rowlake.sources.envelope import decode_with_letters
from rowlake.sources.messages import replay_stream
from rowlake.streaming.ingest import stream_ingest
from test_flow import content, envelope, log

BATCH = [envelope("a.csv", {"k": "1"}), "garbage", {"filename": "b.csv"}, '{"filename": 5, "data": {"k": 1}}', "2024-01-01", envelope("a.csv"), None]
COLUMNS = ("log_partition", "log_offset", "reason", "value")


def batch(spark):
    return log(spark, *[e if e is not None else "{" for e in BATCH]).withColumn("value", F.expr("if(value = '{', null, value)"))


def letters(spark, typed):
    out = decode_with_letters(batch(spark), typed)
    route = route_typed if typed else route_physical
    return {(r.partition, r.offset) for r in route(out.where("size(data) > 0"), letters="dead").where("table_name = 'dead'").collect()}


def test_letters_of_both_decodings_are_the_same(spark):
    assert letters(spark, False) == letters(spark, True) == {(1, 0), (0, 1), (1, 1), (0, 2), (0, 3)}


@pytest.mark.parametrize("typed", [False, True])
def test_drain_keeps_what_it_cannot_read(spark, lake, typed):
    drained = bulk.bulk_ingest(batch(spark), lake, "s", dead_letters="dead", typed=typed)
    assert drained.messages == 7 and drained.malformed >= 1
    assert {w.table_name: w.rows for w in drained.tables} == {"a": 1, "dead": 5}
    found = {r.log_offset * 2 + r.log_partition: (r.reason, r.value) for r in lake.scan("dead").collect()}
    assert found[1] == ("malformed", "garbage") and found[2] == ("no list", '{"filename": "b.csv"}') and found[6] == ("no list", None)
    assert found[4][1] == "2024-01-01" and dict(lake.scan("dead").dtypes)["value"] == "string"
    assert dict(lake.scan("dead").dtypes)["log_offset"] == "bigint"
    bulk.bulk_ingest(batch(spark).withColumn("offset", F.col("offset") + 100), lake, "s", dead_letters="dead", typed=typed)
    assert lake.scan("dead").count() == 10 and content(lake, "a", "k") == [("1",)] * 2


@pytest.mark.parametrize("typed", [False, True])
def test_stream_keeps_malformed_messages(spark, lake, typed):
    path = fx.written_log(spark, batch(spark))
    query = stream_ingest(replay_stream(spark, path), lake, workspace.new_folder(spark, "checkpoint"), drain=True, dead_letters="dead", typed=typed)
    query.awaitTermination()
    assert ("malformed", "garbage") in content(lake, "dead", "reason", "value")
    assert content(lake, "a", "k")[0] == ("1",) and lake.scan("a").where("ingestion_timestamp is null").isEmpty()


def test_letters_in_a_catalog(spark, lake):
    db, ns = namespace(spark)
    sink = rd.RdbmsSink(db, ns)
    bulk.bulk_ingest(batch(spark), lake, "s", sink=sink, dead_letters="dead")
    assert spark.table(db.name(ns, "dead")).count() == 5
