import pytest
from pyspark.sql import functions as F

from rowlake.queries.rdbms import namespace
from rowlake.sources import rdbms as rd
from rowlake.sources.ledger import LEDGER, PartlyInserted
from rowlake.sources.lake import SchemaMismatch
from rowlake.plans.fanout import fan_out
from rowlake.sources.envelope import decode_envelope
from test_flow import envelope, log
from rowlake.operators.shape import route_physical


def batch(spark, *envelopes):
    return route_physical(decode_envelope(log(spark, *envelopes)), "rdbms")


def stored(spark, db, ns, table="a"):
    return sorted((tuple(r) for r in spark.table(db.name(ns, table)).select("k").collect()), key=str)


def lost(*_):
    raise OSError("lost")


def test_replays_and_grown_batches(spark):
    db, ns = namespace(spark)
    sink = rd.RdbmsSink(db, ns)
    first = envelope("a.csv", {"k": "1"}, {"k": "1"}, None)
    for rows in (3, 0, 0):
        written = fan_out(batch(spark, first), sink, "s", 0)
        assert [(w.rows, w.skipped) for w in written] == [(rows, rows == 0)]
    # The same places under another batch or source are other rows; new places of a known batch are a part that is in.
    assert fan_out(batch(spark, first), sink, "s", 1)[0].rows == 3
    assert fan_out(batch(spark, first), sink, "other", 0)[0].rows == 3
    assert stored(spark, db, ns) == [("1",)] * 6 + [(None,)] * 3
    assert fan_out(batch(spark), sink, "s", 9) == []
    with pytest.raises(ValueError, match="ledger"):
        sink.prepare(LEDGER, {"k": "string"})


def test_each_step_may_fail(spark, monkeypatch):
    db, ns = namespace(spark)
    db.append(f"{ns}.a", spark.createDataFrame([("old", None)], "k string, ingestion_timestamp timestamp_ntz"))
    sink = rd.RdbmsSink(db, ns)
    rows = batch(spark, envelope("a.csv", {"k": "1"}, {"k": "2"}), envelope("b.csv", {"k": "3"}))
    for step in ("base", "begun", "row"):
        with monkeypatch.context() as patched:
            add = sink.ledger._add
            patched.setattr(sink.ledger, "_add", lambda e, step=step, add=add: lost() if e.first()["entry"] == step else add(e))
            with pytest.raises(Exception, match="lost"):
                fan_out(rows, sink, "s", 0)
        assert stored(spark, db, ns) == ([("1",), ("2",), ("old",)] if step == "row" else [("old",)])
    with monkeypatch.context() as patched:
        patched.setattr(sink.ledger, "_held", lost)
        with pytest.raises(OSError):
            fan_out(batch(spark, envelope("a.csv", {"k": "1"}, {"k": "2"})), sink, "s", 0)
    fan_out(rows, sink, "s", 0)
    fan_out(rows, sink, "s", 0)
    assert stored(spark, db, ns) == [("1",), ("2",), ("old",)] and stored(spark, db, ns, "b") == [("3",)]
    entries = sink.ledger.entries().groupBy("table_name", "entry").agg(F.count(F.lit(1)), F.sum("rows"))
    found = sorted(tuple(r) for r in entries.collect())
    assert found == [("a", "base", 1, 1), ("a", "begun", 1, None), ("a", "row", 2, None), ("b", "base", 1, 0), ("b", "begun", 1, None), ("b", "row", 1, None)]


def test_a_part_of_a_batch_is_an_error(spark, monkeypatch):
    db, ns = namespace(spark)
    sink = rd.RdbmsSink(db, ns)
    rows = batch(spark, envelope("a.csv", {"k": "1"}, {"k": "2"}, {"k": "3"}))
    insert = db.insert

    def part(schema, table, frame):
        if table == "a":
            insert(schema, table, frame.limit(1))
            raise OSError("lost")
        insert(schema, table, frame)

    with monkeypatch.context() as patched:
        patched.setattr(db, "insert", part)
        with pytest.raises(OSError):
            fan_out(rows, sink, "s", 0)
    with pytest.raises(PartlyInserted, match="1 of the 3 rows"):
        fan_out(rows, sink, "s", 0)
    assert len(stored(spark, db, ns)) == 1


def test_without_a_ledger_and_with_rejects(spark):
    db, ns = namespace(spark)
    plain = rd.RdbmsSink(db, ns, ledger=None)
    rows = batch(spark, envelope("a.csv", {"k": "2024-01-01"}))
    for _ in range(2):
        fan_out(rows, plain, "s", 0)
    assert len(stored(spark, db, ns)) == 2 and not db.exists(ns, LEDGER)
    sink = rd.RdbmsSink(db, ns)
    odd = batch(spark, envelope("a.csv", {"k": "x"}, {"k": "2024-01-02"}))
    for expected in (2, 0):
        assert fan_out(odd, sink, "s", 1, on_type_mismatch="reject")[0].rows == expected
    assert [r.value for r in spark.table(db.name(ns, "a_rejects")).collect()] == ["x"]
    with pytest.raises(SchemaMismatch):
        fan_out(batch(spark, envelope("a.csv", {"new": "1"})), sink, "s", 2)
