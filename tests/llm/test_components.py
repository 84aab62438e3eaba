import random

import pytest

from rowlake.llm import common, nearcopies, simhash
from rowlake.llm import components as graph


@pytest.fixture
def files(spark, monkeypatch):
    """Partitions of each checkpoint, in a session that joins no small partitions by itself."""
    found = []

    def counted(frame, *most):
        out = common.cut(frame, *most)
        found.append(out.rdd.getNumPartitions())
        return out

    for module in (graph, nearcopies, simhash):
        monkeypatch.setattr(module, "cut", counted)
    settings = {"spark.sql.shuffle.partitions": "6", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield found
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_of_a_small_graph_are_a_file_each(spark, files):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    found = {(r.node, r.component) for r in graph.components(edges).collect()}
    assert found == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
    assert len(files) > 2 and set(files[1:]) == {1}


def test_files_grow_with_the_rows(spark, files, monkeypatch):
    monkeypatch.setattr(common, "FILE_ROWS", 10)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    assert {r.component for r in graph.components(edges).collect()} == {0}
    assert files[0] == 6 and set(files[1:]) == {4}


def test_near_copies_of_a_small_table_make_few_files(spark, files):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:-1], f"x{i}"])) for i in range(20)] + [(30 + i, " ".join(rng.choices(base, k=50))) for i in range(5)]
    kept = nearcopies.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 30, 31, 32, 33, 34]
    assert sum(n > 1 for n in files) == 1  # the first links, whose number no bound tells
