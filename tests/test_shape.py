import datetime

import pytest
from pyspark.sql import functions as F

from rowlake.functions import labels, values
from rowlake.operators import shape
from rowlake.sources.envelope import decode_envelope, explode_rows
from rowlake.sources.messages import MESSAGE_SCHEMA

ROWS = "row map<string,string>"


def test_wide_rows_read_as_narrow_ones(spark, monkeypatch):
    cells = [{"a": "1", "b.c": "", "q`t": "é\"\n"}, {"A b": " ", "a": None}, {}]
    frame = spark.createDataFrame([(c,) for c in cells], ROWS)
    columns = ["a", "b.c", "q`t", "A b"]
    narrow = shape.normalize_rows(frame, columns).collect()
    monkeypatch.setattr(shape, "WIDE_TABLE", 2)
    assert shape.normalize_rows(frame, columns).collect() == narrow
    assert [r.asDict() for r in narrow] == [
        {"A b": None, "a": "1", "b.c": None, "q`t": 'é"\n'}, {"A b": " ", "a": None, "b.c": None, "q`t": None},
        {"A b": None, "a": None, "b.c": None, "q`t": None},
    ]


def test_a_row_of_many_columns(spark):
    count = 600
    frame = spark.createDataFrame([({f"c{i}": str(i) for i in range(count)},)], ROWS)
    row = shape.normalize_rows(frame, [f"c{i}" for i in range(count)]).first()
    assert all(row[f"c{i}"] == str(i) for i in range(count))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = {
            "2024-02-29": (datetime.date(2024, 2, 29), "2024-02-29"), "2024-02-30": (None, None), "soon": (None, "soon"),
            "2024-1-5": (None, "2024-1-5"), "2024-01-05 ": (None, "2024-01-05 "), "2024-01-1 ": (None, "2024-01-1 "),
            "2024-01-1T": (None, "2024-01-1T"), "0000-01-01": (None, "0000-01-01"), None: (None, None),
        }
        frame = spark.createDataFrame([(v,) for v in cases], "v string")
        found = frame.select("v", values.to_date(F.col("v")), values.guarded_date(F.col("v"))).collect()
        assert {v: (d, g) for v, d, g in found} == cases
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_date_names():
    named = {"order_date": True, "update": True, "candidate": True, "DOB": True, "dateOfBirth": True, "dated": False, "dobs": False}
    assert {n: values.is_date_column(n) for n in named} == named


def test_timestamps(spark):
    frame = spark.createDataFrame([("2024-01-01T10:00:00.9+02:00",), ("bad",), (None,)], "ingestion_timestamp string")
    found = [r[0] for r in shape.normalize_ingestion_timestamp(frame).collect()]
    assert found[1:] == [None, None] and found[0].microsecond == 0
    other = frame.withColumnRenamed("ingestion_timestamp", "x")
    assert shape.normalize_ingestion_timestamp(other) is other


def test_case_collision():
    with pytest.raises(ValueError, match="Price.*price"):
        shape.check_columns("t", ["Price", "a", "price"])


def test_first_row_columns(spark):
    values = [
        '{"filename":"a.csv","data_format":"csv","data":[{"d":"2024-01-01","x":"1"}]}',
        '{"filename":"a.csv","data_format":"csv","data":[{"d":"2024-01-02","y":"1"}]}',
    ]
    log = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], MESSAGE_SCHEMA)
    flat = shape.flat_first_row(explode_rows(decode_envelope(log)))
    assert flat.columns == ["filename", "data_format", "ingestion_timestamp", "d", "x"]
    assert dict(flat.dtypes)["d"] == "date" and flat.count() == 2


def test_mixed_numbers_keep_their_text(spark):
    from rowlake.sources.envelope import decode_envelope_typed

    value = '{"filename":"a.csv","data":[{"n":1,"m":1},{"n":"many","m":2}]}'
    rows = explode_rows(decode_envelope_typed(spark.createDataFrame([(0, 0, value)], MESSAGE_SCHEMA)))
    frame = shape.typed_frame(rows.withColumn("table_name", F.lit("a")))
    assert dict(frame.dtypes) == {"m": "bigint", "n": "string"}
    assert sorted(r["n"] for r in frame.collect()) == ["1", "many"]


def test_rdbms_labels_agree(spark):
    types = ["tinyint", "int", "bigint", "float", "double", "decimal(9,3)", "boolean", "date", "timestamp", "timestamp_ntz", "string", "array<int>"]
    frame = spark.createDataFrame([(t,) for t in types], "t string")
    for style in ("spark", "wide"):
        for dtype, found in frame.select("t", labels.rdbms_ddl_type(F.col("t"), style)).collect():
            assert found == labels.rdbms_ddl_name(dtype, style)
