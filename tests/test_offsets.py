import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rowlake import workspace
from rowlake.queries import fixtures
from rowlake.sources import offsets
from rowlake.sources.messages import MESSAGE_SCHEMA
from rowlake.sources.offsets import LogIndex, OffsetReader, admitted, offset_stream
from rowlake.streaming.ingest import drained, keep_streaming, stream_ingest


def messages(spark, *ranges):
    rows = [(p, o, json.dumps({"filename": "a.csv", "data": [{"k": f"{p}-{o}"}]})) for p, first, end in ranges for o in range(first, end)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_admission_is_even_and_never_above_the_cap():
    bounds = {0: (0, 100), 1: (0, 3), 2: (50, 60)}
    ends = admitted(bounds, {}, 20)
    assert ends == {0: 8, 1: 3, 2: 59}
    at, steps = {}, 0
    while (ends := admitted(bounds, at, 7)) != at:
        moved = sum(end - at.get(p, bounds[p][0]) for p, end in ends.items())
        assert 0 < moved <= 7
        at, steps = ends, steps + 1
    assert at == {0: 100, 1: 3, 2: 60} and steps == 17
    assert admitted({}, {}, 5) == {} and admitted({}, {4: 9}, 5) == {4: 9}
    assert admitted({0: (500, 510)}, {0: 100}, 4) == {0: 504}  # older files are gone


def test_ranges_from_footers_and_columns(tmp_path):
    def write(name, partition, offset, **options):
        table = pa.table({"partition": pa.array(partition, pa.int32()), "offset": pa.array(offset, pa.int64()), "value": ["v"] * len(offset)})
        pq.write_table(table, tmp_path / name, **options)

    write("one.parquet", [3] * 6, range(6), row_group_size=4)
    write("mixed.parquet", [1, 2, 1, None], [7, 8, 9, 5])
    write("bare.parquet", [1, 1], [10, 11], write_statistics=False)
    write("none.parquet", [], [])
    write("_hidden.parquet", [9], [9])
    index = LogIndex(str(tmp_path))
    assert index.bounds() == {3: (0, 6), 1: (7, 12), 2: (8, 9)}
    assert LogIndex(f"file:{tmp_path}").bounds() == index.bounds() == LogIndex(f"file://{tmp_path}").bounds()
    reader = OffsetReader({"path": str(tmp_path), "maxOffsetsPerTrigger": "4"})
    end = reader.latestOffset()
    assert end == reader.latestOffset() == {"1": 9, "2": 9, "3": 1}
    parts = reader.partitions({}, end)
    read = [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r[:2] for r in read) == [(1, 7), (2, 8), (3, 0)]
    again = OffsetReader({"path": str(tmp_path), "maxOffsetsPerTrigger": "100"})
    assert again.partitions(end, end) == [] and again.latestOffset() == {"1": 12, "2": 9, "3": 6}
    latest = OffsetReader({"path": str(tmp_path), "startingOffsets": "latest"})
    assert latest.initialOffset() == latest.latestOffset() == {"1": 12, "2": 9, "3": 6}
    assert LogIndex(str(tmp_path / "absent")).bounds() == {}
    with pytest.raises(ValueError):
        OffsetReader({"path": "x", "maxOffsetsPerTrigger": "0"})


def test_triggers_restart_and_growth(spark, lake):
    path, checkpoint = workspace.new_folder(spark, "log"), workspace.new_folder(spark, "checkpoint")
    taken, failures = [], []

    def run(fail_after=None):
        def note(batch_id, written):
            taken.append((batch_id, sum(w.rows for w in written)))
            if fail_after is not None and len(taken) == fail_after:
                raise RuntimeError("lost after writing")

        return stream_ingest(offset_stream(spark, path, 10), lake, checkpoint, trigger_interval="0 seconds", on_batch=note)

    messages(spark, (0, 0, 25), (1, 0, 3)).write.parquet(path)
    with pytest.raises(Exception, match="lost after writing"):
        drained(run(fail_after=2))
    drained(run())
    assert [n for _, n in taken] == [10, 10, 10, 8] and [i for i, _ in taken] == [0, 1, 1, 2]
    messages(spark, (1, 3, 9), (2, 100, 130)).write.mode("append").parquet(path)
    taken.clear()
    drained(run())
    assert all(n <= 10 for _, n in taken) and sum(n for _, n in taken) == 36
    drained(run())
    found = sorted(r.k for r in lake.scan("a").select("k").collect())
    assert found == sorted([f"0-{i}" for i in range(25)] + [f"1-{i}" for i in range(9)] + [f"2-{i}" for i in range(100, 130)])
    assert keep_streaming(lambda: stream_ingest(offset_stream(spark, path, 10), lake, checkpoint, drain=True), failures.append) == 0


def test_from_the_latest(spark, lake):
    path, checkpoint = workspace.new_folder(spark, "log"), workspace.new_folder(spark, "checkpoint")
    messages(spark, (0, 0, 5)).write.parquet(path)
    query = stream_ingest(offset_stream(spark, path, 10, "latest"), lake, checkpoint, trigger_interval="0 seconds")
    query.processAllAvailable()
    messages(spark, (0, 5, 7)).write.mode("append").parquet(path)
    drained(query)
    assert sorted(r.k for r in lake.scan("a").select("k").collect()) == ["0-5", "0-6"]
    with pytest.raises(ValueError):
        offset_stream(spark, path, starting_offsets="middle")


def test_a_row_group_of_many_partitions_is_read_once_and_not_to_its_end(tmp_path, monkeypatch):
    table = pa.table({"partition": pa.array([i % 4 for i in range(4000)], pa.int32()), "offset": pa.array([i // 4 for i in range(4000)], pa.int64()), "value": ["v"] * 4000})
    pq.write_table(table, tmp_path / "one.parquet")
    monkeypatch.setattr(offsets, "BATCH_ROWS", 100)
    reader = OffsetReader({"path": str(tmp_path), "maxOffsetsPerTrigger": "40"})
    part, = reader.partitions({}, reader.latestOffset())
    decoded, whole = [], pq.ParquetFile.iter_batches

    def counted(file, *args, **options):
        for batch in whole(file, *args, **options):
            if "value" in options["columns"]:
                decoded.append(batch.num_rows)
            yield batch

    monkeypatch.setattr(pq.ParquetFile, "iter_batches", counted)
    read = [(r["partition"], r["offset"]) for b in reader.read(part) for r in b.to_pylist()]
    assert sorted(read) == [(p, o) for p in range(4) for o in range(10)] and sum(decoded) == 100


def test_segments_hold_few_offsets(spark):
    path = workspace.new_folder(spark, "log")
    log = spark.range(20_000).selectExpr("cast(id % 4 as int) as partition", "5000 - id div 4 as offset", "repeat(uuid(), 10) as value")
    fixtures.append_segments(log, path)
    reader = OffsetReader({"path": path, "maxOffsetsPerTrigger": "2000"})
    held = reader.index.held()
    parts = reader.partitions({}, reader.latestOffset())
    assert len({(h.path, h.group) for h in held}) > len(parts)
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 2000
