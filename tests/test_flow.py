import json

import pytest
from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.operators.shape import route_physical
from rowlake.plans import bulk, fanout
from rowlake.plans.fanout import (
    Limits,
    TableErrors,
    fan_out,
    profile_pages,
    rejects_of,
    staged_rows,
    write_frame,
    write_split_by_filename,
)
from rowlake.queries import fixtures as fx
from rowlake.sources.envelope import decode_envelope
from rowlake.sources.lake import Lake, SchemaMismatch
from rowlake.sources.messages import MESSAGE_SCHEMA, drain_ranges, open_bounds, replay_stream, shares
from rowlake.streaming.ingest import keep_streaming, process_batch, stream_ingest


def log(spark, *envelopes):
    return spark.createDataFrame(
        [(i % 2, i // 2, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(envelopes)], MESSAGE_SCHEMA
    )


def envelope(filename, *data, sent="2024-01-01T10:00:00.7+02:00"):
    return {"filename": filename, "data_format": "csv", "ingestion_timestamp": sent, "data": list(data)}


def content(lake, table, *columns):
    return sorted((tuple(r) for r in lake.scan(table).select(*columns).collect()), key=str)


def routed(frame):
    return route_physical(decode_envelope(frame))


def test_null_rows_and_keyless_tables(spark, lake):
    batch = log(
        spark, envelope("a.csv", {"k": "1"}, None, {}), envelope("empty.csv", None, {}), "garbage", {"filename": "a.csv"}
    )
    written = fan_out(routed(batch), lake, "s", 0)
    assert [(w.table_name, w.rows) for w in written] == [("a", 4)]
    assert content(lake, "a", "k") == [("1",), (None,), (None,), (None,)]
    other = Lake(spark, workspace.new_folder(spark, "test"))
    fan_out(routed(batch), other, "s", 0, keep_null_rows=False)
    assert content(other, "a", "k") == [("1",)]


def test_bulk_counts_and_keeps_keyless_rows(spark, lake):
    batch = log(spark, envelope("a.csv", {"k": "1"}, None), envelope("empty.csv", {}), "garbage", {"filename": "a.csv"})
    drained = bulk.bulk_ingest(batch, lake, "bulk")
    assert (drained.messages, drained.malformed) == (4, 1)
    assert {w.table_name: w.rows for w in drained.tables} == {"a": 2, "empty": 1}
    stamp = F.unix_timestamp("ingestion_timestamp")
    assert {r[0] for r in lake.scan("a").select(stamp).collect()} == {1704096000}


@pytest.mark.parametrize("staging", ["cache", "table", "local"])
def test_stagings_agree(spark, sf_dir, staging):
    lake = fx.new_lake(spark)
    drained = bulk.bulk_ingest(fx.logged(spark, fx.sales_messages(spark, sf_dir)), lake, "bulk", staging=staging)
    expected = {"orders": "orders", "customer": "customer", "line_item": "lineitem"}
    for written in drained.tables:
        assert written.rows == fx.table(spark, sf_dir, expected[written.table_name]).count()
        assert lake.scan(written.table_name).count() == written.rows
    with pytest.raises(ValueError):
        staged_rows(routed(log(spark)), "elsewhere")


def test_staged_copy_is_removed(spark, lake):
    from rowlake.sources import files

    folder = workspace.shared_folder(spark) + "/rowlake"
    before = set(files.names(spark, folder))
    bulk.bulk_ingest(log(spark, envelope("a.csv", {"k": "1"})), lake, "bulk", staging="table")
    assert not [n for n in set(files.names(spark, folder)) - before if n.startswith("staged")]


def test_stream_is_batch(spark, sf_dir):
    path = fx.written_log(spark, fx.sales_messages(spark, sf_dir).repartition(5))
    streamed, drained = fx.new_lake(spark), fx.new_lake(spark)
    batches = []
    stream_ingest(
        replay_stream(spark, path, 2), streamed, workspace.new_folder(spark, "checkpoint"), drain=True,
        on_batch=lambda i, written: batches.append(i),
    ).awaitTermination()
    assert len(batches) >= 3
    bulk.bulk_ingest(spark.read.parquet(path), drained, "bulk")
    left, right = fx.sales_content(streamed.scan), fx.sales_content(drained.scan)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_replayed_batch(spark, lake):
    batch = log(spark, envelope("a.csv", {"k": "1"}, {"k": "2"}))
    for batch_id in (0, 0, 1, 0):
        process_batch(decode_envelope(batch), batch_id, lake, "s")
    assert len(content(lake, "a", "k")) == 4


def test_failed_drain_is_run_again(spark, lake, monkeypatch):
    batch = log(spark, envelope("a.csv", {"k": "1"}), envelope("b.csv", {"k": "2"}))
    commit = bulk.commit_offsets

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(bulk, "commit_offsets", fail)
    with pytest.raises(OSError):
        bulk.bulk_ingest(batch, lake, "bulk")
    monkeypatch.setattr(bulk, "commit_offsets", commit)
    bulk.bulk_ingest(batch, lake, "bulk")
    assert content(lake, "a", "k") == [("1",)] and content(lake, "b", "k") == [("2",)]
    assert bulk.bulk_ingest(batch, lake, "bulk").ranges == {}
    assert bulk.log_backlog(batch, bulk.committed_offsets(lake, "bulk")).first()[0] == 0


def test_drain_in_steps(spark, lake):
    batch = log(spark, *[envelope("a.csv", {"k": str(i)}) for i in range(7)])
    done = bulk.drain_in_steps(batch, lake, "steps", 3)
    assert [d.messages for d in done] == [3, 3, 1]
    assert len(content(lake, "a", "k")) == 7


def test_steps_read_from_all_partitions_and_count_messages(spark, lake):
    numbers = [(p, 100 * o, json.dumps(envelope("a.csv", {"k": f"{p}-{o}"}))) for p, n in ((0, 2), (1, 5), (2, 9)) for o in range(n)]
    messages = spark.createDataFrame(numbers, MESSAGE_SCHEMA)
    done = bulk.drain_in_steps(messages, lake, "steps", 7)
    assert [d.messages for d in done] == [7, 7, 2]
    assert done[0].ranges == {0: (0, 101), 1: (0, 201), 2: (0, 101)}
    assert len(set(content(lake, "a", "k"))) == 16
    assert shares({0: 1, 1: 9, 2: 3}, 9) == {0: 1, 2: 3, 1: 5} and shares({}, 4) == {}
    ends = spark.createDataFrame([(0, 0, 300), (1, 0, 5)], "partition int, first_offset long, end_offset long")
    assert drain_ranges(open_bounds(ends), 8) == {0: (0, 4), 1: (0, 4)}


def test_backlog(spark):
    ends = spark.createDataFrame([(0, 10), (1, 5), (2, 7)], "partition int, end_offset bigint")
    committed = spark.createDataFrame([(0, 10), (1, None)], "partition int, committed bigint")
    assert bulk.topic_backlog(ends, committed).first()[0] == 12
    assert bulk.topic_backlog(ends.where("false"), committed).first()[0] == 0


def test_new_column_needs_an_operation(spark, lake):
    bulk.bulk_ingest(log(spark, envelope("a.csv", {"k": "1"})), lake, "one")
    with pytest.raises(SchemaMismatch, match="new"):
        bulk.bulk_ingest(log(spark, envelope("a.csv", {"k": "1", "new": "2"})), lake, "two")
    assert content(lake, "a", "k") == [("1",)]


def test_declared_type_meets_other_text(spark, lake):
    fan_out(routed(log(spark, envelope("a.csv", {"d": "2024-01-01", "order_date": "soon"}))), lake, "s", 0)
    assert dict(lake.scan("a").dtypes)["d"] == "date"
    written = fan_out(routed(log(spark, envelope("a.csv", {"d": "x", "order_date": "2024-02-30"}, {"d": "2024-03-01"}))), lake, "s", 1)
    assert [(w.rows, w.lost_values) for w in written] == [(2, 2)]
    found = [tuple(r) for r in lake.scan("a").select(F.col("d").cast("string"), "order_date").collect()]
    assert sorted(found, key=str) == [("2024-01-01", "soon"), ("2024-03-01", None), (None, None)]


def test_two_spellings_of_a_table(spark, lake):
    fan_out(routed(log(spark, envelope("Orders.csv", {"k": "1"}), envelope("x/orders.CSV", {"k": "2", "l": "3"}))), lake, "s", 0)
    assert content(lake, "orders", "k", "l") == [("1", None), ("2", "3")]


def test_case_collision_names_both_keys(spark, lake):
    with pytest.raises(ValueError, match="Price.*price"):
        fan_out(routed(log(spark, envelope("a.csv", {"Price": "1"}, {"price": "2"}))), lake, "s", 0)


def test_row_key_named_like_the_stamp(spark, lake):
    bulk.bulk_ingest(log(spark, envelope("a.csv", {"k": "1", "ingestion_timestamp": "never", "filename": "x"})), lake, "bulk")
    assert lake.scan("a").columns == ["k", "ingestion_timestamp"]


def test_pages_of_the_profile(spark, lake):
    batch = log(spark, *[envelope(f"t{i}.csv", {"k": "1", f"l{i}": "2"}) for i in range(5)], envelope("t0.csv", {"m": "3"}))
    staged, release = staged_rows(routed(batch), "cache")
    pages = list(profile_pages(staged, Limits(page_tables=2)))
    release()
    assert [sorted(p) for p in pages] == [["t0", "t1"], ["t2", "t3"], ["t4"]]
    assert sorted(pages[0]["t0"].columns) == ["k", "l0", "m"] and pages[0]["t0"].rows == 2


@pytest.mark.parametrize("staging", ["cache", "table"])
def test_more_tables_than_a_page(spark, lake, staging):
    batch = log(spark, *[envelope(f"/in/t{i}.csv", {"k": str(i)}) for i in range(41)])
    written = bulk.bulk_ingest(batch, lake, "many", limits=Limits(page_tables=7), staging=staging).tables
    assert len(written) == 41 and len(lake.table_names()) == 41
    stored = spark.read.parquet(f"{lake.root}/*/g0/batch=*")
    assert sorted(int(r.k) for r in stored.collect()) == list(range(41))


def test_pages_share_a_write_and_a_staged_file(spark, lake, monkeypatch):
    taken, folders = [], []
    write, read = lake.write_tables, fanout.workspace.new_folder
    monkeypatch.setattr(lake, "write_tables", lambda tables, *args: taken.append(len(tables)) or write(tables, *args))
    monkeypatch.setattr(fanout.workspace, "new_folder", lambda *args: folders.append(read(*args)) or folders[-1])
    monkeypatch.setattr(fanout.files, "delete", lambda *args: None)
    batch = log(spark, *[envelope(f"/in/t{i}.csv", {"k": str(i)}) for i in range(41)])
    bulk.bulk_ingest(batch, lake, "many", limits=Limits(page_tables=7, write_tables=21), staging="table")
    assert taken == [21, 20]
    assert len(spark.read.parquet(folders[0]).inputFiles()) < 41
    assert sorted(int(r.k) for r in spark.read.parquet(f"{lake.root}/*/g0/batch=*").collect()) == list(range(41))


def test_a_thousand_and_one_tables(spark, lake):
    rows = spark.range(1001).select("id", F.concat(F.lit("/in/t"), "id", F.lit(".csv")).alias("filename"))
    written = write_split_by_filename(rows, lake, limits=Limits(page_tables=300))
    assert len(written) == 1001 and sum(w.rows for w in written) == 1001


def test_one_bad_table_does_not_stop_others(spark, lake):
    lake.append("b", spark.createDataFrame([("x",)], "other string"))
    lake.append("d", spark.createDataFrame([("x",)], "other string"))
    batch = log(spark, *[envelope(f"{t}.csv", {"k": t}) for t in "abcd"])
    with pytest.raises(TableErrors) as raised:
        fan_out(routed(batch), lake, "s", 0)
    assert [w.table_name for w in raised.value.failed] == ["b", "d"]
    assert content(lake, "a", "k") == [("a",)] and content(lake, "c", "k") == [("c",)]
    reports = fan_out(routed(batch), lake, "s", 0, on_error="report")
    assert [(w.table_name, bool(w.error)) for w in reports] == [("a", False), ("b", True), ("c", False), ("d", True)]


def test_plain_appends_add_rows(spark, lake):
    frame = spark.createDataFrame([(1,)], "id int")
    for _ in range(2):
        lake.append("t", frame)
        write_split_by_filename(frame.selectExpr("id", "'t.csv' as filename"), lake)
        write_frame(frame, lake, table_name="t")
    lake.rewrite("t", {"id": F.col("id")})
    lake.append("t", frame)
    assert content(lake, "t", "id") == [(1,)] * 7
    for identity in ({"source": "s"}, {"batch_id": 1}):
        with pytest.raises(ValueError, match="together"):
            lake.append("t", frame, **identity)


def test_streams_and_logs_do_not_meet(spark, lake):
    for value in ("1", "2"):
        path = fx.written_log(spark, log(spark, envelope("a.csv", {"k": value}), "garbage"))
        seen = stream_ingest(replay_stream(spark, path), lake, workspace.new_folder(spark, "checkpoint"), drain=True)
        seen.awaitTermination()
        assert seen.lastProgress["observedMetrics"]["envelopes"].asDict() == {"messages": 2, "malformed": 1}
    assert content(lake, "a", "k") == [("1",), ("2",)]
    for name in ("x", "y"):
        bulk.bulk_ingest(log(spark, envelope("b.csv", {"k": name})), lake, name, log_name=name)
    assert content(lake, "b", "k") == [("x",), ("y",)]
    with pytest.raises(ValueError, match="is the log 'x'"):
        bulk.bulk_ingest(log(spark, envelope("b.csv", {"k": "z"})), lake, "x", log_name="z")


def test_rejects_keep_the_text(spark, lake):
    fan_out(routed(log(spark, envelope("a.csv", {"d": "2024-01-01", "e": "2024-01-01"}))), lake, "s", 0)
    odd = routed(log(spark, envelope("a.csv", {"d": "soon", "e": "2024-02-02"}, {"d": "x", "e": "y"})))
    with pytest.raises(SchemaMismatch, match="does not fit"):
        fan_out(odd, lake, "s", 1, on_type_mismatch="error")
    written = fan_out(odd, lake, "s", 1, on_type_mismatch="reject")
    assert [(w.rows, w.lost_values) for w in written] == [(2, 3)]
    assert content(lake, rejects_of("a"), "pos", "column_name", "value") == [(0, "d", "soon"), (1, "d", "x"), (1, "e", "y")]
    fan_out(odd, lake, "s", 1, on_type_mismatch="reject")
    assert len(content(lake, rejects_of("a"), "value")) == 3


def test_reserved_name(spark, lake):
    assert [w.table_name for w in bulk.bulk_ingest(log(spark, envelope("_rowlake.csv", {"k": "1"})), lake, "s").tables] == ["_rowlake"]
    assert content(lake, "_rowlake", "k") == [("1",)]
    assert {r.table_name for r in lake.catalog().collect()} == {"_rowlake"}


def test_split_by_filename(spark, lake):
    flat = spark.createDataFrame(
        [(1, "/a/x.csv", "csv"), (2, "/b/X.json", "json"), (3, None, "csv"), (4, "y.csv", None)],
        "id int, filename string, data_format string",
    )
    write_split_by_filename(flat, lake)
    assert content(lake, "x", "id") == [(1,), (2,)] and content(lake, "unknown", "id") == [(3,)]
    assert lake.scan("y").columns == ["id"]


def test_rerun_keeps_its_ranges(spark, lake, monkeypatch):
    """Messages that arrive after a failure wait for the next drain, even if a rewrite came in between."""
    old = log(spark, envelope("a.csv", {"k": "1"}))
    commit = bulk.commit_offsets
    monkeypatch.setattr(bulk, "commit_offsets", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        bulk.bulk_ingest(old, lake, "bulk")
    monkeypatch.setattr(bulk, "commit_offsets", commit)
    lake.rewrite("a", {c: F.col(c) for c in lake.scan("a").columns})
    grown = log(spark, envelope("a.csv", {"k": "1"}), envelope("a.csv", {"k": "2"}), envelope("a.csv", {"k": "3"}))
    assert bulk.bulk_ingest(grown, lake, "bulk").ranges == {0: (0, 1)}
    assert bulk.bulk_ingest(grown, lake, "bulk").ranges == {0: (1, 2), 1: (0, 1)}
    assert content(lake, "a", "k") == [("1",), ("2",), ("3",)]


def test_empty_batch(spark, lake):
    assert fan_out(routed(log(spark)), lake, "s", 0) == []
    assert fan_out(routed(log(spark)), lake, "s", 0, mode="bulk", staging="table") == []
    assert bulk.bulk_ingest(log(spark), lake, "bulk").tables == []


def test_write_frame(spark, lake):
    frame = spark.createDataFrame([(1, "csv")], "id int, data_format string")
    write_frame(frame, lake, table_name="public.Some-Table")
    write_frame(frame, lake, base=f"{lake.root}/Some_Table")
    write_frame(frame, lake, base=f"{lake.root}/some_table/", table_name="some_table")
    write_frame(frame, lake, base=lake.root + "/", table_name="some_table")
    write_frame(frame.selectExpr("id", "'/x/Some_Table.csv' as filename"), lake)
    assert content(lake, "some_table", "id") == [(1,)] * 5 and lake.table_names() == ["some_table"]
    for place in ({}, {"base": "/somewhere/else"}, {"base": f"{lake.root}/a", "table_name": "b"}, {"base": f"{lake.root}/a/b"}):
        with pytest.raises(ValueError, match="no table of the lake"):
            write_frame(frame, lake, **place)


def test_restart_goes_on_from_the_checkpoint(spark, lake):
    path = fx.written_log(spark, log(spark, envelope("a.csv", {"k": "1"}), envelope("b.csv", {"k": "2"})))
    checkpoint = workspace.new_folder(spark, "checkpoint")
    failures = []

    def start():
        def fail_once(batch_id, written):
            if not failures:
                raise RuntimeError("lost after writing")

        return stream_ingest(replay_stream(spark, path), lake, checkpoint, drain=True, on_batch=fail_once)

    assert keep_streaming(start, failures.append, wait_seconds=0) == 1
    assert content(lake, "a", "k") == [("1",)] and content(lake, "b", "k") == [("2",)]
    failures.clear()
    late = log(spark, envelope("a.csv", {"k": "3"}))
    late.write.mode("append").parquet(path)
    with pytest.raises(Exception, match="lost after writing"):
        keep_streaming(start, restarts=0, wait_seconds=0)


def test_times_without_an_offset(spark, lake):
    sent = "2024-07-01T10:00:00"
    batch = log(spark, envelope("a.csv", {"k": "1"}, sent=sent), envelope("a.csv", {"k": "2"}, sent=sent + "Z"), envelope("a.csv", {"k": "3"}, sent="2024-07-01"))
    bulk.bulk_ingest(batch, lake, "bulk", zone="Europe/Vienna")
    found = lake.scan("a").select("k", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm")).collect()
    assert sorted(map(tuple, found)) == [("1", "2024-07-01 08:00"), ("2", "2024-07-01 10:00"), ("3", "2024-06-30 22:00")]


def test_tables_of_equal_columns_share_one_write(spark, lake, monkeypatch):
    names = ["t a", "t'b", "T=c", "0012", "x?y*z", "l" * 120, "ü"]
    batch = lambda value: routed(log(spark, *[envelope(f"{n}.csv", {"k": f"{n} {value}", "d": "2024-01-01"}, None) for n in names], envelope("own.csv", {"q": value})))
    writes, write = [], Lake.write_tables
    monkeypatch.setattr(Lake, "write_tables", lambda self, tables, *a: (writes.append(sorted(tables)), write(self, tables, *a))[1])
    for staging in ("cache", "table"):
        for value in ("1", "2"):  # the second replaces the first
            written = fan_out(batch(value), lake, staging, 0, staging=staging)
            assert [w.rows for w in written if w.table_name != "own"] == [2] * 7
            if value == "1":
                fan_out(batch("other"), lake, staging, 1, staging=staging)
    assert len(writes) == 6 and all(len(w) == 7 for w in writes)
    for name in sorted(t for t in lake.table_names() if t != "own"):
        table = writes[0][[lake.path(t).rsplit("/", 1)[1] for t in writes[0]].index(name)]
        found = [r.k for r in lake.scan(table).select("k").collect()]
        assert sorted(x.rsplit(" ", 1)[1] for x in found if x) == ["2", "2", "other", "other"] and found.count(None) == 4
    assert fan_out(batch("3"), lake, "c", 0, keep_null_rows=False)[0].rows == 1


def test_tables_written_together_keep_their_own_reports(spark, lake):
    fan_out(routed(log(spark, *[envelope(f"{t}.csv", {"k": "2024-01-01"}) for t in "abcd"])), lake, "s", 0)
    lake.rewrite("c", {c: F.col(c) for c in lake.scan("c").columns})
    lake.append("e", spark.createDataFrame([("x",)], "other string"))
    odd = routed(log(spark, envelope("a.csv", {"k": "no"}, {"k": "2024-02-02"}), envelope("b.csv", {"k": "2024-03-03"}), envelope("d.csv", {"k": "odd"}), envelope("e.csv", {"k": "1"})))
    with pytest.raises(TableErrors) as raised:
        fan_out(odd, lake, "s", 1, on_type_mismatch="error")
    assert [w.table_name for w in raised.value.failed] == ["a", "d", "e"]
    assert content(lake, "a", "k") == content(lake, "d", "k") and len(content(lake, "b", "k")) == 2
    reports = fan_out(odd, lake, "s", 2, on_type_mismatch="reject", on_error="report")
    assert [(w.table_name, w.rows, w.lost_values, bool(w.error)) for w in reports] == [("a", 2, 1, False), ("b", 1, 0, False), ("d", 1, 1, False), ("e", 0, 0, True)]
    assert content(lake, rejects_of("a"), "pos", "value") == [(0, "no")] and content(lake, rejects_of("d"), "value") == [("odd",)]
    again = fan_out(routed(log(spark, *[envelope(f"{t}.csv", {"k": "2024-01-01"}) for t in "abcd"])), lake, "s", 0)
    assert [(w.table_name, w.rows, w.skipped) for w in again] == [("a", 1, False), ("b", 1, False), ("c", 0, True), ("d", 1, False)]
    assert len(content(lake, "c", "k")) == 1 and len(content(lake, "b", "k")) == 3
