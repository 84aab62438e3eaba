"""Queries for schema operations, their results and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake.functions import errors
from rowlake.operators import evidence as ev
from rowlake.operators.evolve import apply_operations as carry_out
from rowlake.plans import service
from rowlake.plans.fanout import fan_out
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed

OPS_SCHEMA = (
    "seq bigint, correlation_id string, plan_id string, idempotency_key string, layer string, kind string, "
    "target string, params map<string,string>"
)


def requests(spark, *operations):
    """Operations given as (kind, target, params), in request order."""
    return spark.createDataFrame(
        [(i, "c", "p", f"i{i}", "LAKE", kind, target, params) for i, (kind, target, params) in enumerate(operations)],
        OPS_SCHEMA,
    )


def _part_lake(spark, sf_dir):
    lake = fx.new_lake(spark)
    part = fx.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("p_partkey"),
        "p_brand",
        F.when(F.col("p_partkey") % 5 == 0, "n/a").otherwise(fx.text("p_size")).alias("p_size"),
    )
    lake.append("part", part, "first", 0)
    return lake, part


def add_column(spark, sf_dir):
    lake, part = _part_lake(spark, sf_dir)
    ops = requests(
        spark,
        ("ADD_COLUMN", "Part", {"column_name": "p_cost", "logical_type": "numeric"}),
        ("ADD_COLUMN", "public.part", {"column_name": "p_size", "logical_type": "int"}),
    )
    carry_out(ops, lake)
    lake.append("part", part.withColumn("p_cost", F.col("p_partkey") / 4), "second", 0)
    return lake.scan("part")


_PART_SQL = "p_partkey::int as p_partkey, p_brand, case when p_partkey % 5 = 0 then 'n/a' else p_size::varchar end as p_size"
ADD_COLUMN = f"""
select {_PART_SQL}, null::decimal(38,10) as p_cost from part
union all select {_PART_SQL}, (p_partkey / 4)::decimal(38,10) from part
"""


def drop_column(spark, sf_dir):
    """Drop two columns, add one of them again: its old values stay gone."""
    lake, part = _part_lake(spark, sf_dir)
    carry_out(
        requests(
            spark,
            ("DROP_COLUMN", "part", {"attribute": "p_brand"}),
            ("DROP_COLUMN", "part", {"column_name": "p_size"}),
            ("DROP_COLUMN", "part", {"column_name": "p_size"}),
        ),
        lake,
    )
    carry_out(requests(spark, ("ADD_COLUMN", "part", {"column_name": "p_size", "logical_type": "text"})), lake)
    lake.append("part", part.drop("p_brand"), "second", 0)
    # A batch that is merged already is not added again.
    lake.append("part", part.drop("p_brand"), "first", 0)
    return lake.scan("part")


DROP_COLUMN = """
select p_partkey::int as p_partkey, null::varchar as p_size from part
union all select p_partkey::int, case when p_partkey % 5 = 0 then 'n/a' else p_size::varchar end from part
"""


def change_type(spark, sf_dir):
    lake, part = _part_lake(spark, sf_dir)
    carry_out(
        requests(
            spark,
            ("CHANGE_TYPE", "part", {"column_name": "P_PARTKEY", "to_logical_type": "long"}),
            ("CHANGE_TYPE", "part", {"column_name": "p_size", "to_logical_type": "double"}),
        ),
        lake,
    )
    lake.append("part", part, "second", 0)
    return lake.scan("part")


CHANGE_TYPE = """
select p_partkey, p_brand, case when p_partkey % 5 <> 0 then p_size::double end as p_size from part, range(2)
"""

# One operation per order: kind, table, column and type follow from its fields.
_KINDS = {
    "1-URGENT": "ADD_COLUMN", "2-HIGH": "DROP_COLUMN", "3-MEDIUM": "CHANGE_TYPE",
    "4-NOT SPECIFIED": "RENAME_COLUMN", "5-LOW": "CHANGE_TYPE",
}
_TARGETS = {"F": "Part", "O": "public.customer", "P": "ghost"}
_COLUMNS = ["p_partkey", "p_name", "c_custkey", "c_name", "extra_one", "extra_two"]
_TYPES = [("bigint", "bigint"), ("text", "string"), ("double", "double"), ("decimal(5,1)", "decimal"), ("date", "date")]


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _by(column, mapping):
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[F.col(column)]


def operations(spark, sf_dir):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    column = F.when(cust % 17 != 0, _pick(_COLUMNS, key + cust))
    params = F.map_filter(
        F.create_map(
            F.lit("column_name"), column,
            F.lit("logical_type"), _pick([t[0] for t in _TYPES], cust),
        ),
        lambda _, v: v.isNotNull(),
    )
    return fx.table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        F.concat(F.lit("c"), key).alias("correlation_id"),
        F.when(cust % 2 == 0, F.concat(F.lit("plan"), cust)).otherwise("").alias("plan_id"),
        F.concat(F.lit("k"), key).alias("idempotency_key"),
        F.when(cust % 13 == 0, "VAULT").otherwise("LAKE").alias("layer"),
        _by("o_orderpriority", _KINDS).alias("kind"),
        F.when(cust % 19 != 0, _by("o_orderstatus", _TARGETS)).alias("target"),
        params.alias("params"),
    )


def _values(rows):
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def operations_sql() -> str:
    """The same operations as a CTE ``o``."""
    return f"""
with o as (
  select o_orderkey as seq, 'c' || o_orderkey as correlation_id,
    case when o_custkey % 2 = 0 then 'plan' || o_custkey else '' end as plan_id, 'k' || o_orderkey as idempotency_key,
    case when o_custkey % 13 = 0 then 'VAULT' else 'LAKE' end as layer, kind,
    case when o_custkey % 19 <> 0 then target end as target,
    case when o_custkey % 17 <> 0 then col end as col, label, norm
  from orders
  join (values {_values(_KINDS.items())}) k(pr, kind) on pr = o_orderpriority
  join (values {_values(_TARGETS.items())}) t(st, target) on st = o_orderstatus
  join (values {_values(enumerate(_COLUMNS))}) c(ci, col) on ci = (o_orderkey + o_custkey) % {len(_COLUMNS)}
  join (values {_values((i, *t) for i, t in enumerate(_TYPES))}) y(yi, label, norm) on yi = o_custkey % {len(_TYPES)})"""


def apply_operations(spark, sf_dir):
    lake = fx.new_lake(spark)
    lake.append("part", fx.table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    lake.append("customer", fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    return carry_out(operations(spark, sf_dir), lake).drop("error_message")


APPLY_OPERATIONS = operations_sql() + """,
i(tkey, col, first) as (values ('part', 'p_partkey', 'bigint'), ('part', 'p_name', 'string'),
  ('customer', 'c_custkey', 'bigint'), ('customer', 'c_name', 'string')),
k as (
  select o.*, first, case target when 'Part' then 'part' when 'public.customer' then 'customer' else target end as tkey
  from o left join i on i.col = o.col
    and i.tkey = case target when 'Part' then 'part' when 'public.customer' then 'customer' end),
v as (select *, layer = 'LAKE' and kind <> 'RENAME_COLUMN' and col is not null and tkey in ('part', 'customer') as valid from k),
p as (select *, coalesce(last_value(case when valid and kind = 'ADD_COLUMN' then true when valid and kind = 'DROP_COLUMN' then false end ignore nulls)
    over (partition by tkey, col order by seq rows between unbounded preceding and 1 preceding), first is not null) as present from v),
y as (select *, coalesce(last_value(case when valid and ((kind = 'ADD_COLUMN' and not present) or (kind = 'CHANGE_TYPE' and present)) then norm end ignore nulls)
    over (partition by tkey, col order by seq rows between unbounded preceding and 1 preceding), first) as cur from p),
r as (select *, case
    when layer <> 'LAKE' then 'WRONG_LAYER' when kind = 'RENAME_COLUMN' then 'UNSUPPORTED_OPERATION'
    when kind = 'ADD_COLUMN' and col is null then 'MISSING_PARAM' when target is null then 'MISSING_TARGET'
    when col is null then 'MISSING_PARAM'
    when tkey = 'ghost' then case when kind = 'DROP_COLUMN' then 'DELTA_NOT_FOUND' else 'DELTA_TABLE_NOT_READY' end
    when kind = 'CHANGE_TYPE' and not present then 'DELTA_COLUMN_NOT_READY' else '' end as error_code from y)
select seq, correlation_id, plan_id, idempotency_key,
  case when error_code = 'WRONG_LAYER' then 'ALREADY_APPLIED'
    when error_code in ('UNSUPPORTED_OPERATION', 'MISSING_PARAM', 'MISSING_TARGET') then 'PERMANENT_ERROR'
    when error_code <> '' then 'TRANSIENT_ERROR'
    when kind = 'ADD_COLUMN' and present then 'ALREADY_APPLIED'
    when kind = 'DROP_COLUMN' and not present then 'ALREADY_APPLIED'
    when kind = 'CHANGE_TYPE' and cur = norm then 'ALREADY_APPLIED'
    else 'OK' end as status,
  error_code,
  case when error_code in ('WRONG_LAYER', 'UNSUPPORTED_OPERATION')
    or (error_code in ('MISSING_PARAM', 'MISSING_TARGET') and kind <> 'CHANGE_TYPE') then ''
    else 'lake:' || coalesce(target, 'unknown') || ':' || coalesce(nullif(plan_id, ''), 'no_plan') || ':' || idempotency_key
  end as evidence_snapshot_id
from r
"""


def evidence_id(spark, sf_dir):
    return operations(spark, sf_dir).select(
        "seq", errors.evidence_id(F.col("target"), F.col("plan_id"), F.col("idempotency_key")).alias("evidence_snapshot_id")
    )


EVIDENCE_ID = operations_sql() + """
select seq, 'lake:' || coalesce(target, 'unknown') || ':' || coalesce(nullif(plan_id, ''), 'no_plan') || ':' || idempotency_key
  as evidence_snapshot_id from o
"""

# Error texts around each document, with the class they belong to.
_ERRORS = [
    ("", "permanent"),
    ("Relation x DOES NOT EXIST: ", "missing_relation"),
    ("column x does not exist in t", "permanent"),
    ("Connection refused by host ", "transient"),
    ("request Timed Out ", "transient"),
    ("the database system is starting up ", "transient"),
    ("server closed the connection, no table ", "transient"),
]


def long_request(spark, sf_dir):
    """A hundred and thirty type changes of one column in one request, then another column."""
    lake, _ = _part_lake(spark, sf_dir)
    types = [("int", "string", "bigint", "string", "double", "bigint")[i % 6] for i in range(130)] + ["bigint"]
    changes = [("CHANGE_TYPE", "part", {"column_name": "p_size", "to_logical_type": t}) for t in types]
    added = ("ADD_COLUMN", "part", {"column_name": "p_cost", "logical_type": "double"})
    results = carry_out(requests(spark, *changes, added), lake)
    statuses = ",".join(sorted({r["status"] for r in results.select("status").distinct().collect()}))
    return lake.scan("part").select("p_partkey", "p_size", "p_cost").withColumn("statuses", F.lit(statuses))


LONG_REQUEST = """
select p_partkey::int as p_partkey, case when p_partkey % 5 <> 0 then p_size::bigint end as p_size,
  null::double as p_cost, 'OK' as statuses from part
"""


def dispatch(spark, sf_dir):
    """One operation per order, answered by the lake through the common entry."""
    lake = fx.new_lake(spark)
    lake.append("part", fx.table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    lake.append("customer", fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    return service.apply_operations(operations(spark, sf_dir), lake).drop("error_message")


def classify_errors(spark, sf_dir):
    """An error log: one line per document, the error text before the document."""
    prefix = _pick([e[0] for e in _ERRORS], F.col("doc_id"))
    log = fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(prefix, F.lit("["), "lang", F.lit("] "), "text").alias("message"),
        F.when(F.col("doc_id") % 23 == 0, "42P01").alias("state"),
    )
    return log.select("doc_id", errors.error_class(F.col("message"), F.col("state")).alias("error_class"))


CLASSIFY_ERRORS = f"""
select doc_id, case when doc_id % 23 = 0 then 'missing_relation' else c end as error_class
from documents join (values {_values((i, e[1]) for i, e in enumerate(_ERRORS))}) e(i, c) on i = doc_id % {len(_ERRORS)}
"""


def _described_lake(spark, sf_dir):
    lake = fx.new_lake(spark)
    fan_out(routed(fx.orders_messages(spark, sf_dir).unionByName(fx.part_messages(spark, sf_dir))), lake, "seen", 0)
    carry_out(requests(spark, ("ADD_COLUMN", "part", {"column_name": "p_cost", "logical_type": "decimal"})), lake)
    return lake


def introspect(spark, sf_dir):
    return ev.introspect(_described_lake(spark, sf_dir))


_SCHEMAS = {
    "orders": {
        **{c: "date" if c == "o_orderdate" else "string" for c in sorted(fx.ORDERS)}, "ingestion_timestamp": "timestamp",
    },
    "part": {**{c: "string" for c in sorted(fx.PART)}, "ingestion_timestamp": "timestamp", "p_cost": "decimal(38,10)"},
}
INTROSPECT = f"""
select * from (values {_values((t, i, c, d, d) for t, s in _SCHEMAS.items() for i, (c, d) in enumerate(s.items()))})
  v(table_name, ordinal, name, logical_type, physical_type), (select true as nullable)
where exists (select 1 from orders) and exists (select 1 from part)
"""


def evidence_json(spark, sf_dir):
    """One request per event, for tables that exist and tables that do not."""
    lake = _described_lake(spark, sf_dir)
    asked = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("c"), "event_id").alias("correlation_id"),
        F.lit("p").alias("plan_id"),
        F.when(F.col("event_type") == "click", "Orders").when(F.col("event_type") == "view", "public.part")
        .otherwise(F.col("event_type")).alias("dataset_id"),
    )
    raw = F.from_json(
        "raw_evidence_json", "backend string, table_name string, exists boolean, columns array<string>, schema array<string>"
    )
    return ev.evidence(asked, lake).withColumn("raw", raw).select(
        "correlation_id",
        "plan_id",
        F.size("tables").alias("tables"),
        F.size("vault_structures").alias("vaults"),
        "raw.backend", "raw.table_name", "raw.exists",
        F.array_join("raw.columns", ",").alias("columns"),
        F.array_join("raw.schema", ",").alias("schema"),
        F.array_join(F.transform(F.get("tables", 0)["attributes"], lambda a: a["physical_type"]), ",").alias("types"),
    )


def _evidence_case(render) -> str:
    cases = " ".join(f"when '{t}' then '{','.join(render(c, d) for c, d in s.items())}'" for t, s in _SCHEMAS.items())
    return f"case tname {cases} end"


EVIDENCE_JSON = f"""
with e as (select event_id, case event_type when 'click' then 'orders' when 'view' then 'part' else event_type end as tname,
  event_type in ('click', 'view') as known from events)
select 'c' || event_id as correlation_id, 'p' as plan_id, known::int as tables, 0 as vaults, 'delta' as backend,
  tname as table_name, case when not known then false end as exists,
  {_evidence_case(lambda c, d: c)} as columns, {_evidence_case(lambda c, d: f'{c}:{d}')} as schema,
  {_evidence_case(lambda c, d: d)} as types
from e
"""

QUERIES = {
    "add_column": (add_column, ADD_COLUMN),
    "drop_column": (drop_column, DROP_COLUMN),
    "change_type": (change_type, CHANGE_TYPE),
    "apply_operations": (apply_operations, APPLY_OPERATIONS),
    "long_request": (long_request, LONG_REQUEST),
    "dispatch": (dispatch, APPLY_OPERATIONS),
    "evidence_id": (evidence_id, EVIDENCE_ID),
    "classify_errors": (classify_errors, CLASSIFY_ERRORS),
    "introspect": (introspect, INTROSPECT),
    "evidence_json": (evidence_json, EVIDENCE_JSON),
}
