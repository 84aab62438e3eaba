import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowlake.functions import errors
from rowlake.plans.service import apply_operations, introspect_evidence
from rowlake.queries.evolution import requests
from rowlake.queries.rdbms import namespace
from rowlake.sources import rdbms as rd
from rowlake.sources.lake import SchemaMismatch


def test_insert_by_name(spark):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([(1, [1, 2], "csv")], "a int, b array<int>, data_format string"))
    db.append(f"{ns}.t", spark.createDataFrame([("[3]", 2)], "b string, a int"))
    db.append(f"{ns}.t", spark.createDataFrame([(3,)], "a int"))
    assert sorted(map(tuple, spark.table(db.name(ns, "t")).collect())) == [(1, "[1,2]"), (2, "[3]"), (3, None)]
    with pytest.raises(AnalysisException):
        db.append(f"{ns}.t", spark.createDataFrame([(4, 1)], "a int, extra int"))


def test_column_types(spark):
    frame = spark.sql(
        "select 1S as s, 1 as i, 1L as l, 1.5F as f, 1.5D as d, cast(1 as decimal(9,2)) as n, true as b, "
        "date'2024-01-01' as day, timestamp'2024-01-01 00:00:00' as t, 'x' as c, map('a', 1) as m, x'00' as raw"
    )
    assert rd.ddl_types(frame) == {
        "s": "INTEGER", "i": "INTEGER", "l": "BIGINT", "f": "DOUBLE PRECISION", "d": "DOUBLE PRECISION",
        "n": "NUMERIC(9,2)", "b": "BOOLEAN", "day": "DATE", "t": "TIMESTAMP", "c": "TEXT", "m": "TEXT", "raw": "TEXT",
    }
    assert dict(rd.insertable(frame).dtypes) == {
        "s": "int", "i": "int", "l": "bigint", "f": "double", "d": "double", "n": "decimal(9,2)", "b": "boolean",
        "day": "date", "t": "timestamp_ntz", "c": "string", "m": "string", "raw": "string",
    }


def test_long_names_are_cut(spark):
    db, ns = namespace(spark)
    written = db.append(f"{ns}." + "x" * 70, spark.createDataFrame([(1,)], "a int"))
    assert written.table_name == f"{ns}." + "x" * 63 and written.rows == 1
    assert db.append(f"{ns}.a.b-c", spark.createDataFrame([(1,)], "a int")).table_name == f"{ns}.b_c"
    assert db.append("plain", spark.createDataFrame([(1,)], "a int")).table_name == f"{ns}.plain"


def test_bulk_insert(spark):
    db, ns = namespace(spark)
    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    assert db.bulk_insert(f"{ns}.t", frame.where("false")).rows == 0
    assert not db.exists(ns, "t")
    assert db.bulk_insert(f"{ns}.t", frame, ["b", "none"]).rows == 1
    row = spark.table(db.name(ns, "t")).first()
    assert row["a"] == 1 and row["insertion_timestamp"] is not None


def test_operations(spark):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([(1, "5"), (2, "")], "a int, b string"))
    asked = requests(
        spark,
        ("ADD_COLUMN", "t", {"schema_name": ns, "attribute": "c", "logical_type": "date"}),
        ("ADD_COLUMN", "t", {"schema_name": ns, "attribute": "c", "logical_type": "date"}),
        ("CHANGE_TYPE", "t", {"schema_name": ns, "column_name": "b", "logical_type": "bigint"}),
        ("CHANGE_TYPE", "t", {"schema_name": ns, "column_name": "zz", "logical_type": "bigint"}),
        ("ADD_COLUMN", "gone", {"schema_name": ns, "attribute": "c", "logical_type": "date"}),
        ("DROP_COLUMN", "gone", {"attribute": "c"}),
        ("DROP_COLUMN", "t", {"attribute": "a"}),
    )
    found = {r["seq"]: (r["status"], r["error_code"]) for r in apply_operations(asked, db).collect()}
    assert found == {
        0: ("OK", ""), 1: ("ALREADY_APPLIED", ""), 2: ("OK", ""), 3: ("TRANSIENT_ERROR", "RDBMS_COLUMN_NOT_READY"),
        4: ("TRANSIENT_ERROR", "RDBMS_TABLE_NOT_READY"), 5: ("ALREADY_APPLIED", ""), 6: ("OK", ""),
    }
    assert spark.table(db.name(ns, "t")).dtypes == [("b", "bigint"), ("c", "date")]
    assert sorted(map(tuple, spark.table(db.name(ns, "t")).collect()), key=str) == [(5, None), (None, None)]


def test_a_failed_cast_keeps_the_table(spark):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([("x",)], "b string"))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    asked = requests(spark, ("CHANGE_TYPE", "t", {"column_name": "b", "logical_type": "bigint"}))
    result = apply_operations(asked, db).first()
    assert (result["status"], result["error_code"]) == ("PERMANENT_ERROR", "RDBMS_CHANGE_TYPE_FAILED")
    assert [tuple(r) for r in spark.table(db.name(ns, "t")).collect()] == [("x",)]
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {rd.identifier('spark_catalog', ns)}").collect() if not r["isTemporary"]] == ["t"]


@pytest.mark.parametrize(
    "message, code, status",
    [
        ("connection refused", "RDBMS_CHANGE_TYPE_TRANSIENT", "TRANSIENT_ERROR"),
        ('relation "t" does not exist', "RDBMS_CHANGE_TYPE_TRANSIENT", "TRANSIENT_ERROR"),
        ("syntax error", "RDBMS_CHANGE_TYPE_FAILED", "PERMANENT_ERROR"),
    ],
)
def test_failed_statements(spark, monkeypatch, message, code, status):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([("5",)], "b string"))

    def fail(*_):
        raise RuntimeError(message)

    monkeypatch.setattr(db, "change", fail)
    asked = requests(spark, ("CHANGE_TYPE", "t", {"schema_name": ns, "column_name": "b", "logical_type": "bigint"}))
    result = db.apply_operations(asked).first()
    assert (result["status"], result["error_code"], result["error_message"]) == (status, code, message)


def test_failed_drop_is_permanent(spark):
    classified = spark.createDataFrame(
        [(1, "c", "p", "i", "OK", "", "", "e", "DROP_COLUMN", "s.t")],
        "seq bigint, correlation_id string, plan_id string, idempotency_key string, status string, error_code string, "
        "error_message string, evidence_snapshot_id string, kind string, table_key string",
    )
    result = rd.rdbms_report(classified, [("s.t", "timeout")]).first()
    assert (result["status"], result["error_code"]) == ("PERMANENT_ERROR", "LAKE_DROP_COLUMN_FAILED")


def test_strict_and_lenient_casts(spark):
    frame = spark.createDataFrame([("5",), ("",), ("x",)], "v string")
    lenient = [r[0] for r in frame.select(rd.change_type_value(F.col("v"), "INTEGER", "lenient")).collect()]
    assert lenient == [5, None, None]
    for ansi in ("false", "true"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="invalid input for type INTEGER: x"):
            frame.select(rd.change_type_value(F.col("v"), "INTEGER")).collect()
        kept = frame.where("v <> 'x'").select(rd.change_type_value(F.col("v"), "INTEGER")).collect()
        assert [r[0] for r in kept] == [5, None]


def test_statements_of_the_database():
    assert rd.type_change_statement("public", "t", "a", "BIGINT") == (
        'ALTER TABLE "public"."t" ALTER COLUMN "a" TYPE BIGINT USING NULLIF("a"::text, \'\')::BIGINT'
    )
    assert rd.type_change_statement("s", 'q"t', "a", "DATE") == 'ALTER TABLE "s"."q""t" ALTER COLUMN "a" TYPE DATE USING "a"::DATE'


def test_create_statement(spark):
    frame = spark.createDataFrame([], "a int, b string, c double")
    ddl = rd.ddl_types(frame)
    wanted = ", ".join(f'"{n}" {t}' for n, t in ddl.items())
    assert rd.create_statement("s", "t", frame) == f'CREATE TABLE IF NOT EXISTS "s"."t" ({wanted})'
    assert list(ddl) == ["a", "b", "c"]


def test_failed_rename_gives_the_name_back(spark, monkeypatch):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([("5",)], "b string"))
    run, renames = spark.sql, []

    def second_fails(statement):
        if "RENAME TO" in statement:
            renames.append(statement)
            if len(renames) == 2:
                raise RuntimeError("lost")
        return run(statement)

    monkeypatch.setattr(spark, "sql", second_fails)
    with pytest.raises(RuntimeError, match="lost"):
        db.change_type(ns, "t", "b", "BIGINT")
    monkeypatch.undo()
    assert [tuple(r) for r in spark.table(db.name(ns, "t")).collect()] == [("5",)]


def test_sink_refuses_new_columns(spark):
    db, ns = namespace(spark)
    sink = rd.RdbmsSink(db, ns)
    assert sink.prepare("t", {"a": "string", "d": "date"}) == {"a": "string", "d": "date"}
    with pytest.raises(SchemaMismatch):
        sink.prepare("t", {"a": "string", "e": "string"})


def test_evidence(spark):
    db, ns = namespace(spark)
    db.append(f"{ns}.t", spark.createDataFrame([(1,)], "a int"))
    asked = spark.createDataFrame([("1", "p", "t"), ("2", "p", "u-1")], "correlation_id string, plan_id string, dataset_id string")
    found = {r["correlation_id"]: r for r in introspect_evidence(asked, db).collect()}
    assert found["1"]["tables"][0]["name"] == f"{ns}.t" and found["1"]["tables"][0]["attributes"][0]["name"] == "a"
    assert found["2"]["tables"] == [] and '"table_name":"u_1","exists":false' in found["2"]["raw_evidence_json"]


def test_error_classes(spark):
    cases = [
        ("x", "42P01", "missing_relation"), ('Table "t" does NOT exist', None, "missing_relation"),
        ("does not exist", None, "permanent"), ("Operation timed out", None, "transient"), (None, None, "permanent"),
    ]
    frame = spark.createDataFrame(cases, "m string, s string, e string")
    assert frame.where(errors.error_class(F.col("m"), F.col("s")) != F.col("e")).count() == 0


def test_jdbc_catalog_settings(spark):
    """Only the settings: connecting needs a database."""
    db = rd.register_jdbc_catalog(spark, "rd_settings", "jdbc:none:x", "no.such.Driver", writers=3, user="u")
    assert spark.conf.get("spark.sql.catalog.rd_settings.batchsize") == "5000"
    assert spark.conf.get("spark.sql.catalog.rd_settings.numPartitions") == "3"
    assert db.name("public", "t`x") == "`rd_settings`.`public`.`t``x`"
