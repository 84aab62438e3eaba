import random

import pytest
from pyspark.sql import functions as F

from rowlake.operators import profile
from rowlake.plans import fanout

ROWS = "table_name string, partition int, offset bigint, pos int, row map<string,string>"


def made_up(seed: int, size: int = 400):
    """Rows of three tables; one of them holds most."""
    rng = random.Random(seed)
    values = ["2024-01-05", "x", "", "2024-02-30", "5", None, "  ", "2024-01-05\n", "12024-01-05"]
    rows = []
    for i in range(size):
        table = "hot" if rng.random() < 0.8 else rng.choice(["a", "b"])
        keys = rng.sample(["k1", "k2", "k3", "filename", "order_date"], rng.randint(0, 4))
        rows.append((table, rng.randint(0, 3), rng.randint(0, 50), i, {k: rng.choice(values) for k in keys}))
    return rows


def expected(rows):
    """The same profile, one row after the other."""
    import re

    out = {}
    for table, *arrival, row in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        entries = [(k if k != "filename" else None, v) for k, v in row.items()] or [(None, None)]
        for key, value in entries:
            entry = out.setdefault((table, key), {"non_null": 0, "hits": 0, "first": None})
            if value not in (None, ""):
                is_date = re.search(r"^\d{4}-\d{2}-\d{2}$", value, re.ASCII) is not None
                entry["non_null"] += 1
                entry["hits"] += is_date
                if entry["first"] is None:
                    entry["first"] = is_date
    return {k: (e["non_null"], e["hits"], bool(e["first"])) for k, e in out.items()}


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("partitions", [1, 7])
def test_profile_is_that_of_a_row_loop(spark, packed, partitions):
    rows = made_up(partitions)
    frame = spark.createDataFrame(rows, ROWS).repartition(partitions)
    found = profile.profile_columns(frame, packed=packed).collect()
    assert {(r["table_name"], r["column_name"]): (r["non_null"], r["date_hits"], r["first_is_date"]) for r in found} == expected(rows)
    per_table = {}
    for r in found:
        per_table[r["table_name"]] = per_table.get(r["table_name"], 0) + r["rows"]
    assert per_table == {t: sum(r[0] == t for r in rows) for t in {r[0] for r in rows}}


def test_arrival_order_is_partition_offset_position(spark):
    frame = spark.createDataFrame(
        [
            ("t", 1, 0, 0, {"c": "late"}),
            ("t", 0, 9_000_000_000_000_000_000, 2_000_000_000, {"c": "late"}),
            ("t", 0, 8_999_999_999_999_999_999, 2_000_000_001, {"c": "2024-01-01"}),
        ],
        ROWS,
    )
    assert profile.profile_columns(frame).first()["first_is_date"]
    # Such offsets do not fit into the packed key, so the batch is profiled with the other one.
    staged = frame.withColumn("ingestion_timestamp", F.lit(None).cast("string"))
    assert frame.agg(profile.packable()).first()[0] is False
    found, = fanout.profile_pages(staged)
    assert found["t"].columns["c"]["first_is_date"]


def test_a_message_of_many_rows_does_not_fit_the_packed_key(spark):
    frame = spark.createDataFrame([("t", 0, 0, 1 << profile.POSITION_BITS, {"c": "x"})], ROWS)
    assert frame.agg(profile.packable()).first()[0] is False


def test_materialized_columns(spark):
    rows = made_up(3)
    found = {tuple(r) for r in profile.materialized_columns(spark.createDataFrame(rows, ROWS)).collect()}
    assert found == {(t, k) for t, *_, row in rows for k in row if k != "filename"}


def test_first_types(spark):
    variant = "map_from_entries(array({}))"
    cells = {
        "flag": ["true", "1"], "whole": ["5", "7"], "part": ["1.5", "2"], "day": ['"2024-01-01"', '"x"'],
        "text": ['"x"', "5"], "blank": ['""', '"2024-01-01"'], "none": ["null", "null"], "nested": ['{"q":1}', "[1]"],
    }
    frames = []
    for pos in (0, 1):
        entries = ", ".join(f"struct('{k}' as key, parse_json('{v[pos]}') as value)" for k, v in cells.items())
        frames.append(
            spark.range(1).select(
                F.lit("t").alias("table_name"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
                F.lit(pos).alias("pos"), F.expr(variant.format(entries)).alias("row"),
            )
        )
    found = {r["column_name"]: (r["type"], r["mixed"]) for r in profile.infer_types(frames[1].union(frames[0])).collect()}
    assert found == {
        "flag": ("BOOLEAN", True), "whole": ("BIGINT", False), "part": ("DOUBLE", True), "day": ("DATE", False),
        "text": ("STRING", True), "blank": ("DATE", False), "none": ("STRING", False), "nested": ("STRING", False),
    }


def test_date_shares(spark):
    values = ["2024-01-01"] * 19 + ["x"]
    frame = spark.createDataFrame(
        [(v, v if i else "y", None, i) for i, v in enumerate(values)], "at95 string, at90 string, never string, n int"
    )
    found = {r["column_name"]: tuple(r)[1:] for r in profile.date_shares(frame, r"^\d{4}-\d{2}-\d{2}$", 0.95).collect()}
    assert found == {"at95": (20, 19, True), "at90": (20, 18, False), "never": (0, 0, False)}
