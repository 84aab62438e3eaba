"""Files of tables on the driver's own disk, and what many tables share."""

import os
import threading

from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.operators import profile
from rowlake.plans import fanout
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed
from rowlake.sources import files
from rowlake.sources.lake import Lake
from rowlake.sources.messages import MESSAGE_SCHEMA, replay_stream
from rowlake.sources.offsets import offset_stream
from rowlake.streaming.ingest import drained, stream_ingest
from test_offsets import messages


def test_files_on_the_own_disk_are_made_without_hadoop(spark, monkeypatch):
    folder = workspace.new_folder(spark, "files")
    monkeypatch.setattr(files, "_fs", lambda *_: (_ for _ in ()).throw(AssertionError("Hadoop was asked")))
    for root in (f"{folder}/bare", f"file:{folder}/one", f"file://{folder}/three"):
        assert not files.exists(spark, root) and files.names(spark, root) == [] and files.holding(spark, root, "a.json") == []
        files.replace_text(spark, f"{root}/t %3A/a.json", "ä\r\n")
        files.replace_text(spark, f"{root}/t %3A/a.json", "ö\r\n")
        assert files.read_text(spark, f"{root}/t %3A/a.json") == "ö\r\n" and files.read_text(spark, f"{root}/b") is None
        files.rename(spark, f"{root}/t %3A", f"{root}/deep/u")
        files.delete(spark, f"{root}/absent")
        assert files.names(spark, root) == ["deep"] and files.holding(spark, f"{root}/deep", "a.json") == ["u"]
    assert files.local_path(spark, "s3a://bucket/x") is files.local_path(spark, "file://host/x") is None


def test_a_checksum_that_hadoop_left_goes_with_its_text(spark):
    folder = workspace.new_folder(spark, "files")
    path = files._path(spark, f"{folder}/a.json")
    files._fs(spark, path).create(path, True).close()
    assert os.path.exists(f"{folder}/.a.json.crc")
    files.replace_text(spark, f"{folder}/a.json", "text")
    assert spark.read.text(f"{folder}/a.json").collect()[0][0] == "text" and files.names(spark, folder) == ["a.json"]


def test_rename_to_a_taken_place_is_as_hadoop_does(spark):
    folder = workspace.new_folder(spark, "files")
    for name in ("a", "b"):
        files.replace_text(spark, f"{folder}/{name}/f", name)
    files.rename(spark, f"{folder}/a", f"{folder}/b")
    assert files.read_text(spark, f"{folder}/b/f") == "b" and files.read_text(spark, f"{folder}/b/a/f") == "a"


def test_writes_of_many_tables_have_no_checksum_files(spark, lake):
    rows = spark.range(40).select(F.concat(F.lit("t"), F.col("id") % 4).alias("table_name"), "id")
    for table in ("t0", "t1", "t2", "t3", "t4"):
        lake.prepare(table, {"id": "bigint"})
    written = lake.write_tables(["t0", "t1", "t2", "t3", "t4"], rows, "s", 0)
    assert {w.table_name: w.rows for w in written} == {"t0": 10, "t1": 10, "t2": 10, "t3": 10, "t4": 0}
    found = [f for _, _, own in os.walk(lake.root) for f in own]
    assert not [f for f in found if f.endswith(".crc")] and Lake(spark, lake.root).table_names() == ["t0", "t1", "t2", "t3", "t4"]


def test_threads_take_over_properties_once_each(spark, monkeypatch):
    wrapped, whole = [], fanout.inheritable_thread_target
    monkeypatch.setattr(fanout, "inheritable_thread_target", lambda session: lambda f: wrapped.append(f) or whole(session)(f))
    threads = set()

    def write(table):
        threads.add(threading.get_ident())
        if table == "t07":
            raise ValueError("no")
        return fanout.Written(table, 1)

    names = [f"t{i:02d}" for i in range(50)]
    written = fanout.for_each_table(spark, reversed(names), write, 4)
    assert [w.table_name for w in written] == names and [w.table_name for w in written if w.error] == ["t07"]
    assert len(wrapped) == 4 >= len(threads) and fanout.for_each_table(spark, [], write, 4) == []


def test_rows_of_tables_of_any_name(spark):
    names = ["plain", "with space", "o'clock", "back\\slash", "${x}", "naïve-1", "line\nbreak"]
    rows = spark.createDataFrame([(n,) for n in [*names, "other"]], "table_name string")
    assert sorted(r[0] for r in rows.where(fanout.of_tables(names)).collect()) == sorted(names)
    assert [r[0] for r in rows.where(fanout.of_tables({"plain": 1})).collect()] == ["plain"]
    assert rows.where(fanout.of_tables([])).count() == 0


def test_batches_known_to_be_large_are_not_cached(spark, sf_dir, monkeypatch):
    chosen, whole = [], fanout.staged_rows
    monkeypatch.setattr(fanout, "staged_rows", lambda rows, how: chosen.append(how) or whole(rows, how))
    path = fx.written_log(spark, fx.orders_messages(spark, sf_dir))
    found = []
    for most in (fanout.CACHED_BYTES, 1):
        monkeypatch.setattr(fanout, "CACHED_BYTES", most)
        lakes = [fx.new_lake(spark) for _ in range(3)]
        fanout.fan_out(routed(fx.orders_messages(spark, sf_dir)), lakes[0], "s", 0)
        stream_ingest(replay_stream(spark, path), lakes[1], workspace.new_folder(spark, "checkpoint"), drain=True).awaitTermination()
        drained(stream_ingest(offset_stream(spark, path), lakes[2], workspace.new_folder(spark, "checkpoint"), trigger_interval="0 seconds"))
        found += [sorted(map(str, lake.scan("orders").select(*fx.ORDERS).collect())) for lake in lakes]
    # A source that does not know its size admits a share per trigger.
    assert chosen == ["cache"] * 3 + ["table", "table", "cache"]
    assert all(own == found[0] and own for own in found)


def test_a_trigger_takes_three_jobs(spark, lake):
    path, checkpoint = workspace.new_folder(spark, "log"), workspace.new_folder(spark, "checkpoint")
    messages(spark, (0, 0, 25), (1, 0, 3)).coalesce(1).write.parquet(path)
    query = drained(stream_ingest(offset_stream(spark, path, 10), lake, checkpoint, trigger_interval="0 seconds"))
    triggers = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    # The batch, its profile, and the write of its one table.
    assert len(triggers) == 3 and 0 < len(jobs) <= 3 * len(triggers)
    assert sorted(r.k for r in lake.scan("a").select("k").collect()) == sorted([f"0-{i}" for i in range(25)] + [f"1-{i}" for i in range(3)])


def test_one_task_profiles_as_many_do(spark, sf_dir):
    staged, release = fanout.staged_rows(routed(fx.logged(spark, fx.sales_messages(spark, sf_dir))), "cache")
    pages = [list(fanout.profile_pages(staged, fanout.Limits(page_tables=2), cached=True, one_task=one)) for one in (False, True)]
    release()
    assert pages[0] == pages[1] and [list(page) for page in pages[0]] == [["customer", "line_item"], ["orders"]]


def test_only_micro_batches_of_few_tasks_are_profiled_by_one(spark, sf_dir):
    assert not fanout.read_by_few(routed(fx.orders_messages(spark, sf_dir)))
    rdd = spark.createDataFrame(spark.sparkContext.parallelize([(0, 0, "{}")], 2), MESSAGE_SCHEMA)
    assert fanout.read_by_few(routed(rdd)) and not fanout.read_by_few(routed(rdd.unionByName(rdd)))


def test_expressions_of_a_batch_are_made_once(spark):
    assert profile._profile_parts(("a",), True) is profile._profile_parts(("a",), True) is not profile._profile_parts(("b",), True)
    made = [fanout.typed_columns({"d": "date", "n": "bigint"}, ["d", "n"], mode, {})[0] for mode in ("stream", "stream", "bulk")]
    assert made[0][0] is made[1][0] is not made[2][0]
    rows = spark.createDataFrame([("2024-01-02", "x"), (None, "7")], "v0 string, v1 string")
    assert [tuple(map(str, r)) for r in rows.select(*made[0]).collect()] == [("2024-01-02", "None"), ("None", "7")]
