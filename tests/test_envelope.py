import json

import pytest
from pyspark.sql import functions as F

from rowlake.sources import envelope
from rowlake.sources.messages import MESSAGE_SCHEMA, bounded_drain, drain_ranges, offset_bounds

VALUES = '{"a":1,"b":1.50,"c":1e3,"d":true,"e":null,"f":{"q":1},"g":"","h":1,"h":2}'
MESSAGES = [
    "garbage",
    '{"filename":"b.csv"}',
    '{"filename":"c.csv","data":{"a":1}}',
    '{"filename":"d.csv","data":[]}',
    '{"filename":"e.csv","ingestion_timestamp":"t","data":[{"a":1},null]}',
    '{"filename":"f.csv","data":[%s]}' % VALUES,
]


def frame(spark, values=MESSAGES):
    return spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], MESSAGE_SCHEMA)


def test_stream_rows(spark):
    decoded = envelope.decode_envelope(frame(spark))
    assert [r["malformed"] for r in decoded.orderBy("offset").collect()][:2] == [True, False]
    found = envelope.explode_rows(decoded).orderBy("offset", "pos").select("offset", "filename", "pos", "row").collect()
    assert [(r["offset"], r["filename"], r["pos"], r["row"]) for r in found[:6]] == [
        (0, None, None, None), (1, "b.csv", None, None), (2, "c.csv", None, None), (3, "d.csv", None, None),
        (4, "e.csv", 0, {"a": "1"}), (4, "e.csv", 1, None),
    ]
    assert found[6]["row"] == {
        "a": "1", "b": "1.5", "c": "1000.0", "d": "true", "e": None, "f": '{"q":1}', "g": "", "h": "2",
    }


def test_bulk_rows_skip_messages_without_a_list(spark):
    decoded = envelope.decode_envelope_typed(frame(spark))
    assert sorted(r["offset"] for r in decoded.select("offset").collect()) == [3, 4, 5]


def test_row_or_data(spark):
    decoded = envelope.decode_envelope(frame(spark))
    exploded = envelope.accept_row_or_data(decoded)
    assert envelope.accept_row_or_data(exploded) is exploded
    for wrong in (decoded.drop("data"), decoded.withColumn("row", F.lit(1))):
        with pytest.raises(ValueError):
            envelope.accept_row_or_data(wrong)


def test_metadata_replaces_row_keys(spark):
    value = json.dumps({"filename": "x.csv", "ingestion_timestamp": "now", "data": [{"ingestion_timestamp": "old", "filename": "y", "k": "1"}, None]})
    rows = envelope.explode_rows(envelope.decode_envelope(frame(spark, [value])))
    done = envelope.stamp_file_metadata(envelope.propagate_ingestion_timestamp(rows)).orderBy("pos")
    first, second = (r["row"] for r in done.collect())
    assert first == {"k": "1", "ingestion_timestamp": "now", "filename": "x.csv", "data_format": None}
    assert second == {"ingestion_timestamp": "now", "filename": "x.csv", "data_format": None}


def test_drain(spark):
    log = spark.createDataFrame([(p, o, "") for p in (0, 1) for o in range(5, 15)], MESSAGE_SCHEMA)
    committed = spark.createDataFrame([(0, 12), (1, 0)], "partition int, committed bigint")
    assert drain_ranges(offset_bounds(log, committed)) == {0: (12, 15), 1: (5, 15)}
    assert drain_ranges(offset_bounds(log, committed), 5) == {0: (12, 15), 1: (5, 7)}
    assert bounded_drain(log, 5, committed).count() == 5
    assert bounded_drain(log, 0, committed).count() == 0
    done = spark.createDataFrame([(0, 15), (1, 15)], "partition int, committed bigint")
    assert drain_ranges(offset_bounds(log, done)) == {}
