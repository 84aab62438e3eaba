import random

import pytest
from pyspark.sql import functions as F

from rowlake.operators import evolve
from rowlake.operators.evolve import apply_operations, classify_operations
from rowlake.queries.evolution import OPS_SCHEMA
from rowlake.sources import files

LAKE = [("part", ["p_id:int", "p_name:string", "price:decimal(18,2)"]), ("cust", ["c_id:bigint"])]
RDBMS = [("public.part", ["p_id:int", "p_name:string"]), ("other.part", ["x:string"])]
CATALOG = "table_name string, ordinal int, name string, dtype string"


def catalog(spark, tables):
    return spark.createDataFrame(
        [(t, i, *c.split(":")) for t, columns in tables for i, c in enumerate(columns)], CATALOG
    )


def op(seq, kind, target, layer="LAKE", plan="p", **params):
    return (seq, f"c{seq}", plan, f"i{seq}", layer, kind, target, params)


def ops(spark, *operations):
    return spark.createDataFrame(list(operations), OPS_SCHEMA)


def verdicts(frame):
    return {r["seq"]: (r["status"], r["error_code"]) for r in frame.collect()}


STATUS = {"T": "TRANSIENT_ERROR", "P": "PERMANENT_ERROR", "A": "ALREADY_APPLIED", "O": "OK"}


def check(spark, backend, tables, cases):
    asked = ops(spark, *[op(i, *case[:2], **case[2]) for i, case in enumerate(cases)])
    found = {r["seq"]: r for r in classify_operations(asked, catalog(spark, tables), backend).collect()}
    for i, (kind, target, params, status, code, has_evidence) in enumerate(cases):
        assert (found[i]["status"], found[i]["error_code"]) == (STATUS[status], code), cases[i]
        expected = f"lake:{target or 'unknown'}:p:i{i}" if has_evidence else ""
        assert found[i]["evidence_snapshot_id"] == expected, cases[i]
        assert bool(found[i]["error_message"]) == bool(code)


def test_lake_contract(spark):
    check(spark, "lake", LAKE, [
        ("ADD_COLUMN", "part", {"layer": "VAULT"}, "A", "WRONG_LAYER", False),
        ("RENAME_COLUMN", "part", {}, "P", "UNSUPPORTED_OPERATION", False),
        ("NEW_HUB", None, {}, "P", "UNSUPPORTED_OPERATION", False),
        ("ADD_COLUMN", None, {}, "P", "MISSING_PARAM", False),
        ("ADD_COLUMN", None, {"attribute": "a"}, "P", "MISSING_PARAM", False),
        ("ADD_COLUMN", None, {"column_name": "a"}, "P", "MISSING_TARGET", False),
        ("ADD_COLUMN", "ghost", {"column_name": "a"}, "T", "DELTA_TABLE_NOT_READY", True),
        ("ADD_COLUMN", "part", {"column_name": "p_id"}, "A", "", True),
        ("ADD_COLUMN", "part", {"column_name": "P_ID"}, "P", "DELTA_ALTER_FAILED", True),
        ("ADD_COLUMN", "part", {"column_name": "fresh"}, "O", "", True),
        ("ADD_COLUMN", None, {"column_name": "fresh2", "table_name": "public.Part"}, "O", "", True),
        ("DROP_COLUMN", None, {"column_name": "a"}, "P", "MISSING_TARGET", False),
        ("DROP_COLUMN", "part", {}, "P", "MISSING_PARAM", False),
        ("DROP_COLUMN", "ghost", {"column_name": "a"}, "T", "DELTA_NOT_FOUND", True),
        ("DROP_COLUMN", "part", {"column_name": "a"}, "A", "", True),
        ("DROP_COLUMN", "part", {"column_name": "P_NAME"}, "A", "", True),
        ("DROP_COLUMN", "part", {"attribute": "p_name"}, "O", "", True),
        ("CHANGE_TYPE", None, {"column_name": "a", "logical_type": "int"}, "P", "MISSING_TARGET", True),
        ("CHANGE_TYPE", "part", {"column_name": "p_id"}, "P", "MISSING_PARAM", True),
        ("CHANGE_TYPE", "part", {"to_logical_type": "int"}, "P", "MISSING_PARAM", True),
        ("CHANGE_TYPE", "ghost", {"column_name": "a", "to_logical_type": "int"}, "T", "DELTA_TABLE_NOT_READY", True),
        ("CHANGE_TYPE", "part", {"column_name": "a", "to_logical_type": "int"}, "T", "DELTA_COLUMN_NOT_READY", True),
        ("CHANGE_TYPE", "part", {"column_name": "PRICE ", "to_logical_type": "numeric(9)"}, "A", "", True),
        ("CHANGE_TYPE", "cust", {"column_name": "c_id", "to_logical_type": "long"}, "A", "", True),
        ("CHANGE_TYPE", "cust", {"column_name": "c_id", "logical_type": "text"}, "O", "", True),
    ])


def test_rdbms_contract(spark):
    check(spark, "rdbms", RDBMS, [
        ("ADD_COLUMN", None, {}, "P", "MISSING_TARGET", False),
        ("ADD_COLUMN", "part", {}, "P", "MISSING_PARAM", False),
        ("ADD_COLUMN", "Part", {"attribute": "a"}, "T", "RDBMS_TABLE_NOT_READY", True),
        ("ADD_COLUMN", "part", {"attribute": "p_id"}, "A", "", True),
        ("ADD_COLUMN", "part", {"attribute": "a", "schema_name": "nope"}, "T", "RDBMS_TABLE_NOT_READY", True),
        ("ADD_COLUMN", "part", {"attribute": "a", "schema_name": "other"}, "O", "", True),
        ("ADD_COLUMN", "part", {"column_name": "P_ID"}, "O", "", True),
        ("DROP_COLUMN", None, {}, "P", "MISSING_TARGET", False),
        ("DROP_COLUMN", "part", {}, "P", "MISSING_PARAM", False),
        ("DROP_COLUMN", "ghost", {"attribute": "a"}, "A", "", True),
        ("DROP_COLUMN", "part", {"attribute": "a", "schema_name": "other"}, "A", "", True),
        ("DROP_COLUMN", "part", {"attribute": "p_name"}, "O", "", True),
        ("CHANGE_TYPE", None, {}, "P", "MISSING_TARGET", False),
        ("CHANGE_TYPE", "part", {"attribute": "p_id"}, "P", "MISSING_PARAM", False),
        ("CHANGE_TYPE", "ghost", {"attribute": "a", "logical_type": "int"}, "T", "RDBMS_TABLE_NOT_READY", True),
        ("CHANGE_TYPE", "part", {"attribute": "zz", "logical_type": "int"}, "T", "RDBMS_COLUMN_NOT_READY", True),
        ("CHANGE_TYPE", "part", {"attribute": "p_id", "logical_type": "int"}, "O", "", True),
    ])


def test_unreadable_table(spark):
    broken = catalog(spark, LAKE).union(spark.createDataFrame([("bad", None, None, None)], CATALOG))
    asked = ops(
        spark,
        op(0, "CHANGE_TYPE", "bad", column_name="a", logical_type="int"),
        op(1, "ADD_COLUMN", "bad", column_name="a"),
        op(2, "DROP_COLUMN", "bad", column_name="a"),
    )
    assert verdicts(classify_operations(asked, broken)) == {
        0: ("TRANSIENT_ERROR", "DELTA_READ_TRANSIENT"), 1: ("PERMANENT_ERROR", "DELTA_ALTER_FAILED"),
        2: ("PERMANENT_ERROR", "DELTA_DROP_COLUMN_FAILED"),
    }


TYPES = {"int": "int", "bigint": "bigint", "text": "string", "decimal": "decimal(38,10)"}


def one_after_the_other(operations, tables):
    """The contract for valid operations on known tables, as a loop over a dictionary."""
    state = {t: dict(c.split(":") for c in columns) for t, columns in tables}
    norm = lambda t: "decimal" if t.startswith("decimal") else t
    out = {}
    for seq, _, _, _, _, kind, target, params in operations:
        columns, name, dtype = state[target], params["column_name"], TYPES[params["logical_type"]]
        if kind == "ADD_COLUMN":
            out[seq] = "ALREADY_APPLIED" if name in columns else "OK"
            columns.setdefault(name, dtype)
        elif kind == "DROP_COLUMN":
            out[seq] = "OK" if columns.pop(name, None) else "ALREADY_APPLIED"
        elif name not in columns:
            out[seq] = "TRANSIENT_ERROR"
        elif norm(columns[name]) == norm(dtype):
            out[seq] = "ALREADY_APPLIED"
        else:
            out[seq], columns[name] = "OK", dtype
    return out, state


def made_up(seed, size=300):
    rng = random.Random(seed)
    return [
        op(
            i * 3, rng.choice(["ADD_COLUMN", "DROP_COLUMN", "CHANGE_TYPE", "CHANGE_TYPE"]),
            "part" if rng.random() < 0.8 else "cust",
            column_name=rng.choice(["hot", "hot", "hot", "p_id", "p_name", "c_id"]), logical_type=rng.choice(list(TYPES)),
        )
        for i in range(size)
    ]


@pytest.mark.parametrize("block", [None, 7, 100, 100_000])
def test_order_of_operations(spark, block):
    operations = made_up(block or 1)
    expected, _ = one_after_the_other(operations, LAKE)
    found = classify_operations(ops(spark, *operations).repartition(5), catalog(spark, LAKE), block=block)
    assert {r["seq"]: r["status"] for r in found.collect()} == expected


def table(spark, lake):
    data = spark.createDataFrame([(1, "7", "2.5", 10), (2, "x", None, 20)], "i int, s string, d string, keep int")
    lake.append("t", data.coalesce(1))
    return data


def test_folded_effect(spark, lake):
    """Many operations on one table: the schema is that of the loop, and at most one generation is written."""
    for name, columns in LAKE:
        lake.ensure(name, dict(c.split(":") for c in columns))
        lake.append(name, spark.range(3).select(*[F.lit(5).cast(c.split(":")[1]).alias(c.split(":")[0]) for c in columns]))
    operations = made_up(99, 60)
    expected, state = one_after_the_other(operations, LAKE)
    results = apply_operations(ops(spark, *operations), lake)
    assert {r["seq"]: r["status"] for r in results.collect()} == expected
    for name, columns in state.items():
        assert dict(lake.scan(name).dtypes) == columns
        assert lake.scan(name).count() == 3
        assert lake.state(name).generation <= 1


def test_chain_of_casts(spark, lake):
    table(spark, lake)
    apply_operations(
        ops(
            spark,
            op(1, "CHANGE_TYPE", "t", column_name="s", logical_type="int"),
            op(2, "CHANGE_TYPE", "t", column_name="d", logical_type="int"),
            op(3, "CHANGE_TYPE", "t", column_name="S", logical_type="text"),
            op(4, "CHANGE_TYPE", "t", column_name="d", logical_type="double"),
            op(5, "CHANGE_TYPE", "t", column_name="i", logical_type="long"),
        ),
        lake,
    )
    assert lake.scan("t").dtypes == [("i", "bigint"), ("s", "string"), ("d", "double"), ("keep", "int")]
    # Every step is carried out, as one request after the other would: 'x' is lost, 2.5 is no integer text.
    assert sorted(map(tuple, lake.scan("t").collect())) == [(1, "7", None, 10), (2, None, None, 20)]
    assert lake.state("t").generation == 1


def test_metadata_only_changes_write_no_files(spark, lake):
    table(spark, lake)
    apply_operations(
        ops(
            spark,
            op(1, "CHANGE_TYPE", "t", column_name="i", logical_type="bigint"),
            op(2, "ADD_COLUMN", "t", column_name="n", logical_type="double"),
            op(3, "DROP_COLUMN", "t", column_name="s"),
        ),
        lake,
    )
    assert lake.state("t").generation == 0
    assert sorted(map(tuple, lake.scan("t").collect())) == [(1, "2.5", 10, None), (2, None, 20, None)]
    apply_operations(ops(spark, op(4, "ADD_COLUMN", "t", column_name="S", logical_type="text")), lake)
    assert lake.state("t").generation == 1
    assert sorted(map(tuple, lake.scan("t").collect())) == [(1, "2.5", 10, None, None), (2, None, 20, None, None)]


def test_failure_is_reported_per_operation(spark, lake, monkeypatch):
    table(spark, lake)
    lake.append("u", spark.range(2).select(F.col("id").cast("int").alias("i")))
    rewrite = type(lake).rewrite
    monkeypatch.setattr(type(lake), "rewrite", lambda self, t, *c: (_ for _ in ()).throw(RuntimeError("disk")) if t == "t" else rewrite(self, t, *c))
    found = apply_operations(
        ops(
            spark,
            op(1, "CHANGE_TYPE", "t", column_name="s", logical_type="int"),
            op(2, "ADD_COLUMN", "t", column_name="keep", logical_type="int"),
            op(3, "CHANGE_TYPE", "u", column_name="i", logical_type="text"),
        ),
        lake,
    )
    assert verdicts(found) == {
        1: ("PERMANENT_ERROR", "DELTA_CHANGE_TYPE_FAILED"), 2: ("ALREADY_APPLIED", ""), 3: ("OK", ""),
    }
    assert "disk" in found.where("seq = 1").first()["error_message"]
    assert dict(lake.scan("t").dtypes)["s"] == "string"


def test_long_chains(spark, lake, monkeypatch):
    monkeypatch.setattr(evolve, "NESTED_CASTS", 2)
    table(spark, lake)
    before = lake.scan("t").collect()
    kinds = ["int", "text", "bigint", "double", "text", "date", "text"]
    found = apply_operations(
        ops(
            spark, *[op(i, "CHANGE_TYPE", "t", column_name="s", logical_type=k) for i, k in enumerate(kinds)],
            op(99, "ADD_COLUMN", "t", column_name="more", logical_type="int"),
        ), lake,
    )
    assert {v[0] for v in verdicts(found).values()} == {"OK"}
    assert dict(lake.scan("t").dtypes)["s"] == "string" and "more" in lake.scan("t").columns
    assert lake.scan("t").count() == len(before)


def test_casts_that_repeat_are_shortened():
    assert evolve.shortened(["int", "string"] * 60 + ["bigint"]) == ("int", "string", "bigint")
    assert evolve.shortened(["int", "int", "string", "int", "string"]) == ("int", "string")
    assert evolve.shortened([]) == ()


def test_purge_leaves_one_generation(spark, lake):
    table(spark, lake)
    apply_operations(ops(spark, op(1, "DROP_COLUMN", "t", column_name="s")), lake, purge=True)
    assert [n for n in files.names(spark, lake.path("t")) if n.startswith("g")] == [f"g{lake.state('t').generation}"]
    assert "s" not in spark.read.option("recursiveFileLookup", "true").parquet(lake.path("t") + "/g*").columns
