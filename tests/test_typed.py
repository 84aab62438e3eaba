import json
import uuid

from pyspark.sql import functions as F

from rowlake.operators.shape import route_typed
from rowlake.plans import bulk
from rowlake.plans.fanout import profile_pages, staged_rows
from rowlake.sources.envelope import decode_envelope_typed
from rowlake.sources.messages import MESSAGE_SCHEMA


def log(spark, *envelopes):
    return spark.createDataFrame([(i % 2, i // 2, json.dumps(e)) for i, e in enumerate(envelopes)], MESSAGE_SCHEMA)


def envelope(filename, *data):
    return {"filename": filename, "data_format": "json", "ingestion_timestamp": "2024-01-01T10:00:00Z", "data": list(data)}


def content(lake, table, *columns):
    return sorted((tuple(r) for r in lake.scan(table).select(*columns).collect()), key=str)


def jobs(spark, tables):
    staged, release = staged_rows(route_typed(decode_envelope_typed(log(spark, *[envelope(f"t{i}.csv", {"a": i, f"b{i}": 1.5}) for i in range(tables)]))), "table")
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "profile")
    try:
        pages = list(profile_pages(staged, typed=True))
        assert sum(map(len, pages)) == tables and pages[0]["t1"].columns["b1"]["type"] == "DOUBLE"
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        release()


def test_profile_jobs_do_not_grow_with_tables(spark):
    assert jobs(spark, 3) == jobs(spark, 40) > 0


def test_types_of_all_tables(spark, lake):
    batch = log(
        spark,
        envelope("a.json", {"n": 1, "x": 1.50, "t": True, "d": "2024-01-02", "s": "", "m": 1, "o": {"q": [1]}}, None),
        envelope("b.json", {"n": "1", "x": None, "D": "2024-01-01", "ingestion_timestamp": "never", "filename": "f"}),
        envelope("a.json", {"n": 2, "x": 1e3, "t": None, "d": "soon", "s": "2024-05-06", "m": "two", "o": 5}),
        envelope("c.json", {}),
        {"filename": "a.json"}, envelope("a.json"),
    )
    drained = bulk.bulk_ingest(batch, lake, "s", typed=True, staging="cache")
    assert (drained.messages, drained.malformed) == (6, 0)
    assert {w.table_name: w.rows for w in drained.tables} == {"a": 3, "b": 1, "c": 1}
    assert dict(lake.scan("a").dtypes) == {"d": "date", "m": "string", "n": "string", "o": "string", "s": "date", "t": "string", "x": "string", "ingestion_timestamp": "timestamp"}
    text = [F.col(c).cast("string") for c in ("n", "x", "t", "d", "s", "m", "o")]
    assert content(lake, "a", *text) == sorted(
        [("1", "1.5", "true", "2024-01-02", None, "1", '{"q":[1]}'), ("2", "1000.0", None, None, "2024-05-06", "two", "5"), (None,) * 7], key=str
    )
    assert lake.scan("b").columns == ["D", "n", "x", "ingestion_timestamp"] and content(lake, "b", "n") == [("1",)]
    assert content(lake, "c", F.col("ingestion_timestamp").isNotNull()) == [(True,)]
    assert bulk.bulk_ingest(batch, lake, "s", typed=True).ranges == {}
    for _ in range(2):
        assert {w.rows for w in bulk.typed_ingest(batch, lake, "typed", 0)} == {3, 1}
    assert len(content(lake, "a", "n")) == 6
