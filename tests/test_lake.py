import pytest
from pyspark.sql import functions as F

from rowlake.functions.naming import physical_table_name
from rowlake.sources.lake import Lake, SchemaMismatch, TableState, file_count, first_fit


def frame(spark, *rows, schema="id int, name string"):
    return spark.createDataFrame(list(rows), schema)


def content(lake, table):
    return sorted((tuple(r) for r in lake.scan(table).collect()), key=str)


def test_append_by_name(spark, lake):
    lake.append("t", frame(spark, (1, "a")), source="s", batch_id=0)
    lake.append("t", frame(spark, ("b", 2), schema="name string, id int"), source="s", batch_id=1)
    lake.append("t", frame(spark, (3,), schema="id int"), source="s", batch_id=2)
    assert content(lake, "t") == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(SchemaMismatch, match="extra"):
        lake.append("t", frame(spark, (4, "d"), schema="id int, extra string"), source="s", batch_id=3)
    assert len(content(lake, "t")) == 3


def test_declared_type_wins(spark, lake):
    lake.append("t", frame(spark, (1, "a")), source="s", batch_id=0)
    text = frame(spark, ("2", "b"), ("x", "c"), schema="id string, name string")
    with pytest.raises(SchemaMismatch):
        lake.append("t", text, source="s", batch_id=1, on_type_mismatch="error")
    assert lake.append("t", text, source="s", batch_id=1).lost_values == 1
    assert content(lake, "t") == [(1, "a"), (2, "b"), (None, "c")]


def test_replay_replaces(spark, lake):
    for _ in range(2):
        assert lake.append("t", frame(spark, (1, "a"), (2, "b")), "s", 4).rows == 2
    lake.append("t", frame(spark, (1, "a")), "other", 4)
    assert len(content(lake, "t")) == 3


def test_replay_after_rewrite_is_skipped(spark, lake):
    lake.append("t", frame(spark, (1, "a")), "s", 0)
    lake.rewrite("t", {"id": F.col("id"), "name": F.upper("name")})
    assert lake.append("t", frame(spark, (1, "a")), "s", 0).skipped
    lake.append("t", frame(spark, (2, "b")), "s", 1)
    assert content(lake, "t") == [(1, "A"), (2, "b")]
    assert lake.state("t").generation == 1 and lake.state("t").merged == {"s": [[0, 0]]}
    lake.rewrite("t", {"id": F.col("id")})
    assert lake.state("t").merged == {"s": [[0, 1]]}
    assert content(lake, "t") == [(1,), (2,)]


def test_a_late_batch_after_a_rewrite_is_written(spark, lake):
    for batch_id in (5, 7, 6, 9):
        lake.append("t", frame(spark, (batch_id, "a")), "s", batch_id)
    lake.rewrite("t", {"id": F.col("id"), "name": F.col("name")})
    assert lake.state("t").merged == {"s": [[5, 7], [9, 9]]}
    assert [lake.append("t", frame(spark, (i, "a")), "s", i).skipped for i in (3, 6, 8, 9)] == [False, True, False, True]
    assert content(lake, "t") == [(i, "a") for i in (3, 5, 6, 7, 8, 9)]
    lake.rewrite("t", {"id": F.col("id")})
    assert lake.state("t").merged == {"s": [[3, 3], [5, 9]]}
    assert TableState.from_json(lake.state("t").to_json().replace("[[3, 3], [5, 9]]", "4")).merged == {"s": [[0, 4]]}


def test_rewrite_of_an_empty_table(spark, lake):
    lake.ensure("t", {"id": "int"})
    assert content(lake, "t") == []
    lake.rewrite("t", {"id": F.col("id").cast("string")})
    assert lake.scan("t").dtypes == [("id", "string")] and content(lake, "t") == []


def test_partitioned_table(spark, lake):
    rows = frame(spark, (1, "a"), (2, "b"), (3, None))
    lake.append("t", rows, source="s", batch_id=0, partition_by=["name", "absent"])
    lake.append("t", rows, source="s", batch_id=1)
    assert lake.scan("t").columns == ["id", "name"] and len(content(lake, "t")) == 6
    assert lake.scan("t").where("name = 'a'").count() == 2
    with pytest.raises(ValueError):
        lake.append("u", frame(spark, (1, "a"), schema="id int, batch string"), partition_by=["batch"])


def test_names_that_look_like_patterns(spark, lake):
    for name in ("a?b", "a*b", "x=y", "c:d", "e%20f", "g{h}", "0012"):
        physical = spark.range(1).select(physical_table_name(F.lit(name))).first()[0]
        lake.append(physical, frame(spark, (1, name)))
        assert content(lake, physical) == [(1, name)]
    assert lake.catalog().select("table_name").distinct().count() == 7
    with pytest.raises(ValueError):
        lake.path("")


def test_exists_and_missing(spark, lake):
    asked = spark.createDataFrame([("t",), ("u",)], "table_name string")
    assert [r["exists"] for r in lake.exists(asked).collect()] == [False, False]
    lake.append("t", frame(spark, (1, "a")))
    assert {r["table_name"]: r["exists"] for r in lake.exists(asked).collect()} == {"t": True, "u": False}
    assert lake.state("u") is None
    with pytest.raises(LookupError):
        lake.scan("u")


def test_case_collision_is_refused(spark, lake):
    with pytest.raises(ValueError, match="case"):
        lake.ensure("t", {"Price": "string", "price": "string"})


def test_file_count():
    cases = [(0, 3), (1, 0), (10_001, 10), (500_000, 10), (5_000_000, 10), (50_000_000, 10), (20_000, 1000)]
    assert [file_count(*c) for c in cases] == [1, 1, 2, 8, 8, 50, 8]


@pytest.mark.parametrize("partition_by", [[], ["name"]])
def test_small_batches_are_packed(spark, lake, partition_by):
    for i in range(6):
        lake.append("t", frame(spark, (i, f"n{i % 2}")), "s", i, partition_by=partition_by)
    lake.append("t", frame(spark, (9, None)), partition_by=partition_by)
    lake.append("t", frame(spark, (7, "z")), "other", 3)
    expected = content(lake, "t")
    before = lake.scan("t")
    assert len(lake.compact("t", 1 << 20)[0]) == 8 and content(lake, "t") == expected
    assert before.count() == 8  # a reader that has begun
    assert [lake.append("t", frame(spark, (i, "again")), "s", i).skipped for i in (0, 5)] == [True, True]
    assert lake.append("t", frame(spark, (3, "again")), "other", 3).skipped
    assert lake.compact("t", 1 << 20) == []
    lake.append("t", frame(spark, (20, "late")), "s", 6)
    lake.append("t", frame(spark, (21, "late")), "s", 9)
    lake.append("t", frame(spark, (22, "late")), "s", 9)
    assert len(lake.vacuum("t")) == 8 and lake.state("t").packed == []
    assert len(lake.compact("t", 1 << 20)[0]) == 3
    assert content(lake, "t") == sorted([*expected, (20, "late"), (22, "late")], key=str)
    lake.vacuum("t")
    assert lake.state("t").merged == {"s": [[0, 6], [9, 9]], "other": [[3, 3]]} and len(lake._batches("t", lake.state("t"))) == 1
    lake.rewrite("t", {"id": F.col("id"), "name": F.col("name")})
    assert content(lake, "t") == sorted([*expected, (20, "late"), (22, "late")], key=str)
    assert lake.append("t", frame(spark, (6, "x")), "s", 6).skipped and lake.state("t").packs == []


def test_an_unfinished_pack_is_not_read(spark, lake, monkeypatch):
    for i in range(3):
        lake.append("t", frame(spark, (i, "a")), "s", i)
    store = Lake.store
    monkeypatch.setattr(Lake, "store", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        lake.compact("t", 1 << 20)
    monkeypatch.setattr(Lake, "store", store)
    assert len(content(lake, "t")) == 3
    assert len(lake.vacuum("t")) == 1
    lake.compact("t", 1 << 20)
    assert content(lake, "t") == [(i, "a") for i in range(3)]


def test_first_fit():
    assert first_fit({"a": 5, "b": 4, "c": 3, "d": 3, "e": 1}, 8) == [["a", "c"], ["b", "d", "e"]]
    assert first_fit({}, 8) == [] and first_fit({"x": 9}, 8) == [["x"]]
