"""Queries for tables of a Spark catalog.

They run on the session catalog with Parquet tables in the shared folder: the
statements are those a JDBC catalog gets, and no database is needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.operators import evidence as ev
from rowlake.operators.evolve import classify_operations
from rowlake.operators.shape import route_physical
from rowlake.plans.fanout import fan_out
from rowlake.queries import fixtures as fx
from rowlake.queries.evolution import operations, operations_sql, requests
from rowlake.sources import rdbms as rd
from rowlake.sources.envelope import decode_envelope
from rowlake.sources.ledger import LEDGER

CATALOG = "spark_catalog"


def namespace(spark) -> tuple[rd.Rdbms, str]:
    """A new namespace of the session catalog, in the shared folder."""
    name = f"rowlake_{uuid.uuid4().hex}"
    folder = workspace.new_folder(spark, "tables")
    spark.sql(f"CREATE NAMESPACE {rd.identifier(CATALOG, name)} LOCATION '{folder}'")
    return rd.Rdbms(spark, CATALOG, name), name


def rdbms_append(spark, sf_dir):
    """Two appends by column name; the second lacks a column, a nested one becomes text."""
    db, ns = namespace(spark)
    events = fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.to_date("ts").alias("seen"),
        F.col("event_type").alias("kind"),
        F.lit("csv").alias("data_format"),
    )
    errors = F.col("kind") == "error"
    db.append(f"{ns}.events", events.where(~errors))
    db.append(f"{ns}.events", events.where(errors).select("seen", "event_id"))
    return spark.table(db.name(ns, "events"))


RDBMS_APPEND = """
select event_id, case when event_type <> 'error' then replace(props, ' ', '') end as props, ts::date as seen,
  case when event_type <> 'error' then event_type end as kind from events
"""


def rdbms_bulk_insert(spark, sf_dir):
    db, ns = namespace(spark)
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    db.bulk_insert(f"{ns}.part", part, drop_columns=["p_brand", "absent"])
    db.bulk_insert(f"{ns}.part", part.where("false"))
    read = spark.table(db.name(ns, "part"))
    return read.withColumn("stamped", F.col("insertion_timestamp").isNotNull()).drop("insertion_timestamp")


def _columns(spark, sf_dir):
    db, ns = namespace(spark)
    db.append(f"{ns}.part", fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    db.append(f"{ns}.orders", fx.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate")))
    found = db.columns([(ns, "part"), (ns, "orders"), (ns, "ghost")])
    return found.withColumn("table_name", F.regexp_replace("table_name", f"^{ns}", "public"))


def rdbms_catalog(spark, sf_dir):
    return ev.describe(_columns(spark, sf_dir))


RDBMS_CATALOG = """
select * from (values ('public.part', 0, 'p_partkey', 'bigint', 'bigint', true), ('public.part', 1, 'p_name', 'string', 'string', true),
  ('public.part', 2, 'p_size', 'int', 'int', true), ('public.orders', 0, 'o_orderkey', 'bigint', 'bigint', true),
  ('public.orders', 1, 'o_orderdate', 'date', 'date', true)) v(table_name, ordinal, name, logical_type, physical_type, nullable)
where exists (select 1 from part) and exists (select 1 from orders)
"""


def evidence_rdbms(spark, sf_dir):
    asked = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("c"), "event_id").alias("correlation_id"),
        F.lit("p").alias("plan_id"),
        F.when(F.col("event_type") == "click", "orders").when(F.col("event_type") == "view", "part")
        .otherwise("Gho.st-1").alias("dataset_id"),
    )
    answers = ev.evidence_rdbms(asked, _columns(spark, sf_dir))
    return answers.select("correlation_id", F.get("tables", 0)["name"].alias("name"), "raw_evidence_json")


EVIDENCE_RDBMS = """
select 'c' || event_id as correlation_id,
  case event_type when 'click' then 'public.orders' when 'view' then 'public.part' end as name,
  '{"backend":"rdbms","schema":"public","table_name":' || case event_type
    when 'click' then '"orders","exists":true,"columns":["o_orderkey","o_orderdate"]}'
    when 'view' then '"part","exists":true,"columns":["p_partkey","p_name","p_size"]}'
    else '"Gho_st_1","exists":false}' end as raw_evidence_json
from events
"""


def fan_out_rdbms(spark, sf_dir):
    """The sales log into catalog tables."""
    db, ns = namespace(spark)
    rows = route_physical(decode_envelope(fx.sales_messages(spark, sf_dir)), "rdbms")
    fan_out(rows, rd.RdbmsSink(db, ns), "sales", 0, staging="table")
    return fx.sales_content(lambda table: spark.table(db.name(ns, table)))


def rdbms_replay(spark, sf_dir):
    """One batch twice, a batch that fails after staging and is run again, and one whose entries were lost."""
    db, ns = namespace(spark)
    sink = rd.RdbmsSink(db, ns)
    log = decode_envelope(fx.logged(spark, fx.orders_messages(spark, sf_dir)))
    written = []

    def run(batch_id, part):
        rows = route_physical(log.where(F.col("partition") == part), "rdbms")
        written.append(sum(w.rows for w in fan_out(rows, sink, "orders", batch_id)))

    def failing(of, name, when):
        """The batch, with one step of it failing."""
        step = getattr(of, name)
        setattr(of, name, lambda *args: (_ for _ in ()).throw(OSError("lost")) if when(*args) else step(*args))
        try:
            run(1 if of is db else 2, 1 if of is db else 2)
        except OSError:
            written.append(-1)
        finally:
            setattr(of, name, step)

    run(0, 0)
    run(0, 0)
    failing(db, "insert", lambda schema, table, frame: table != LEDGER)
    run(1, 1)
    failing(sink.ledger, "_add", lambda entries: "log_offset" in entries.columns and not entries.where("log_offset is not null").isEmpty())
    run(2, 2)
    run(3, 3)
    runs = ",".join("all" if n > 0 else "none" if n == 0 else "lost" for n in written)
    return spark.table(db.name(ns, "Orders")).select("o_orderkey", "o_orderstatus").withColumn("runs", F.lit(runs))


RDBMS_REPLAY = """
select o_orderkey::varchar as o_orderkey, o_orderstatus, 'all,none,lost,all,lost,none,all' as runs from orders
"""


def add_column_rdbms(spark, sf_dir):
    db, ns = namespace(spark)
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    db.append(f"{ns}.part", part)
    params = {"column_name": "p_cost", "to_logical_type": "Double"}
    results = db.apply_operations(requests(spark, ("ADD_COLUMN", "part", params)))
    db.append(f"{ns}.part", part.withColumn("p_cost", F.col("p_partkey") / 4))
    status = results.first()["status"]
    return spark.table(db.name(ns, "part")).withColumn("status", F.lit(status))


ADD_COLUMN_RDBMS = """
select p_partkey, p_name, null::double as p_cost, 'OK' as status from part
union all select p_partkey, p_name, p_partkey / 4, 'OK' from part
"""


def drop_column_rdbms(spark, sf_dir):
    """Drop a column and add it again: its old values are gone."""
    db, ns = namespace(spark)
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    db.append(f"{ns}.part", part)
    results = db.apply_operations(
        requests(
            spark,
            ("DROP_COLUMN", "part", {"attribute": "p_size"}),
            ("DROP_COLUMN", "part", {"column_name": "p_name"}),
            ("ADD_COLUMN", "part", {"column_name": "p_size", "logical_type": "int"}),
            ("DROP_COLUMN", "part", {"column_name": "p_name"}),
        )
    )
    db.append(f"{ns}.part", part.drop("p_name"))
    statuses = ",".join(r["status"] for r in results.orderBy("seq").collect())
    return spark.table(db.name(ns, "part")).withColumn("statuses", F.lit(statuses))


DROP_COLUMN_RDBMS = """
select p_partkey, case when n = 1 then p_size end as p_size, 'OK,OK,OK,ALREADY_APPLIED' as statuses
from part, range(2) r(n)
"""


def change_type_rdbms(spark, sf_dir):
    """Three changes of one table, text to numbers, through one copy of it; '' becomes NULL."""
    db, ns = namespace(spark)
    text = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(fx.text("p_size"))
    part = fx.table(spark, sf_dir, "part").select("p_partkey", *[text.alias(c) for c in ("p_size", "p_wide", "p_real")])
    db.append(f"{ns}.part", part)
    copies, replace = [], db._replace
    db._replace = lambda *parts: (copies.append(parts), replace(*parts))
    types = {"p_size": "integer", "p_wide": "bigint", "p_real": "double"}
    changes = [
        ("CHANGE_TYPE", "part", {"schema_name": ns, "attribute": c, "to_logical_type": t}) for c, t in types.items()
    ]
    statuses = {r["status"] for r in db.apply_operations(requests(spark, *changes)).collect()}
    out = spark.table(db.name(ns, "part"))
    return out.withColumn("status", F.lit(",".join(sorted(statuses)))).withColumn("copies", F.lit(len(copies)))


CHANGE_TYPE_RDBMS = """
select p_partkey, case when p_partkey % 5 <> 0 then p_size end as p_size,
  case when p_partkey % 5 <> 0 then p_size::bigint end as p_wide, case when p_partkey % 5 <> 0 then p_size::double end as p_real,
  'OK' as status, 1 as copies from part
"""


def change_type_nullif(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = F.when(key % 6 == 0, "").when(key % 6 == 1, "x1").otherwise(fx.text("o_custkey"))
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    strict = F.when(F.col("raw") != "x1", F.col("raw"))
    return orders.select(
        "o_orderkey",
        rd.change_type_value(F.col("raw"), "BIGINT", "lenient").alias("as_bigint"),
        rd.change_type_value(strict, "INTEGER").alias("as_int"),
        rd.change_type_value(F.col("raw"), "TEXT").alias("as_text"),
        rd.change_type_value(F.concat(F.lit("2024-01-1"), key % 3), "DATE").alias("as_date"),
    )


CHANGE_TYPE_NULLIF = """
select o_orderkey, case when o_orderkey % 6 > 1 then o_custkey end as as_bigint,
  case when o_orderkey % 6 > 1 then o_custkey::int end as as_int,
  case o_orderkey % 6 when 0 then '' when 1 then 'x1' else o_custkey::varchar end as as_text,
  ('2024-01-1' || (o_orderkey % 3))::date as as_date from orders
"""


def operations_rdbms(spark, sf_dir):
    """Verdicts for one operation per order against the tables of a catalog."""
    catalog = _columns(spark, sf_dir)
    ops = operations(spark, sf_dir).withColumn("target", F.regexp_replace(F.lower("target"), r"public\.customer", "orders"))
    return classify_operations(ops, catalog, "rdbms").select("seq", "status", "error_code", "evidence_snapshot_id", "new_type")


OPERATIONS_RDBMS = operations_sql() + """,
i(tkey, col, first) as (values ('part', 'p_partkey', 1), ('part', 'p_name', 1), ('part', 'p_size', 1)),
k as (select o.* replace (case target when 'Part' then 'part' when 'public.customer' then 'orders' else target end as target) from o),
j as (select k.*, first from k left join i on i.col = k.col and i.tkey = k.target),
v as (select *, layer = 'LAKE' and kind <> 'RENAME_COLUMN' and col is not null and target in ('part', 'orders') as valid from j),
p as (select *, coalesce(last_value(case when valid and kind = 'ADD_COLUMN' then true when valid and kind = 'DROP_COLUMN' then false end ignore nulls)
    over (partition by target, col order by seq rows between unbounded preceding and 1 preceding), first is not null) as present from v),
r as (select *, case
    when layer <> 'LAKE' then 'WRONG_LAYER' when kind = 'RENAME_COLUMN' then 'UNSUPPORTED_OPERATION'
    when target is null then 'MISSING_TARGET' when col is null then 'MISSING_PARAM'
    when kind = 'DROP_COLUMN' then '' when target = 'ghost' then 'RDBMS_TABLE_NOT_READY'
    when kind = 'CHANGE_TYPE' and not present then 'RDBMS_COLUMN_NOT_READY' else '' end as error_code from p)
select seq,
  case when error_code = 'WRONG_LAYER' then 'ALREADY_APPLIED'
    when error_code in ('UNSUPPORTED_OPERATION', 'MISSING_PARAM', 'MISSING_TARGET') then 'PERMANENT_ERROR'
    when error_code <> '' then 'TRANSIENT_ERROR'
    when kind = 'ADD_COLUMN' and present then 'ALREADY_APPLIED'
    when kind = 'DROP_COLUMN' and (target = 'ghost' or not present) then 'ALREADY_APPLIED' else 'OK' end as status,
  error_code,
  case when error_code in ('WRONG_LAYER', 'UNSUPPORTED_OPERATION', 'MISSING_PARAM', 'MISSING_TARGET') then ''
    else 'lake:' || target || ':' || coalesce(nullif(plan_id, ''), 'no_plan') || ':' || idempotency_key end as evidence_snapshot_id,
  case label when 'bigint' then 'BIGINT' when 'double' then 'DOUBLE PRECISION' when 'date' then 'DATE' else 'TEXT' end as new_type
from r
"""

QUERIES = {
    "fan_out_rdbms": (fan_out_rdbms, fx.sales_sql()),
    "rdbms_append": (rdbms_append, RDBMS_APPEND),
    "rdbms_replay": (rdbms_replay, RDBMS_REPLAY),
    "rdbms_bulk_insert": (rdbms_bulk_insert, "select p_partkey, p_name, p_size, true as stamped from part"),
    "rdbms_catalog": (rdbms_catalog, RDBMS_CATALOG),
    "evidence_rdbms": (evidence_rdbms, EVIDENCE_RDBMS),
    "add_column_rdbms": (add_column_rdbms, ADD_COLUMN_RDBMS),
    "drop_column_rdbms": (drop_column_rdbms, DROP_COLUMN_RDBMS),
    "change_type_rdbms": (change_type_rdbms, CHANGE_TYPE_RDBMS),
    "change_type_nullif": (change_type_nullif, CHANGE_TYPE_NULLIF),
    "operations_rdbms": (operations_rdbms, OPERATIONS_RDBMS),
}
