"""Queries for type inference, conversion and type labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake.functions import labels, values
from rowlake.operators import profile, shape
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed
from rowlake.sources.envelope import decode_envelope_typed, explode_rows


def typed_events(spark, sf_dir):
    """Typed event rows, with one key that turns from numbers to text."""
    log = fx.event_messages(spark, sf_dir)
    mixed = F.regexp_replace("value", r'"event_id":(\d*[02468]),', r'"event_id":$1,"mixed":$1,')
    mixed = F.regexp_replace(mixed, r'"event_id":(\d*[13579]),', r'"event_id":$1,"mixed":"no $1",')
    rows = explode_rows(decode_envelope_typed(log.withColumn("value", mixed)))
    return rows.withColumn("table_name", F.lit("events"))


def infer_types(spark, sf_dir):
    return profile.infer_types(typed_events(spark, sf_dir))


INFER_TYPES = """
select 'events' as table_name, * from (values
  ('event_id', 'BIGINT', false), ('user_id', 'BIGINT', false), ('value', 'DOUBLE', false),
  ('event_type', 'STRING', false), ('seen', 'DATE', false), ('is_error', 'BOOLEAN', false),
  ('nothing', 'STRING', false), ('props', 'STRING', false), ('mixed', 'BIGINT', true)) t(column_name, type, mixed)
where exists (select 1 from events)
"""


def typed_frame(spark, sf_dir):
    frame = shape.typed_frame(typed_events(spark, sf_dir))
    return frame.withColumn("types", F.lit(",".join(f"{n}:{t}" for n, t in frame.dtypes)))


TYPED_FRAME = """
select event_id, case when event_id % 4 <> 0 then user_id end as user_id, value,
  case when event_id % 6 <> 0 then event_type end as event_type,
  case when event_id % 8 <> 3 then ts::date end as seen, event_type = 'error' as is_error,
  null::varchar as nothing, replace(props, ' ', '') as props,
  case when event_id % 2 = 0 then event_id::varchar else 'no ' || event_id end as mixed,
  'event_id:bigint,event_type:string,is_error:boolean,mixed:string,nothing:string,props:string,seen:date,'
  || 'user_id:bigint,value:double' as types
from events
"""


def _order_rows(spark, sf_dir, **extra):
    fields = {"o_orderkey": "cast(o_orderkey as string)", **extra}
    return routed(fx.messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, fields))


def date_by_first(spark, sf_dir):
    rows = _order_rows(
        spark, sf_dir,
        first_date=f"if(o_orderkey % 4 = 1, 'n/a', {fx.ORDERS['o_orderdate']})",
        first_text=f"if(o_orderkey = 0, 'n/a', {fx.ORDERS['o_orderdate']})",
    )
    columns = profile.profile_columns(rows).where("column_name is not null").collect()
    types = {c["column_name"]: "date" if c["first_is_date"] else "string" for c in columns}
    return shape.typed_rows(rows, types)


DATE_BY_FIRST = """
select o_orderkey::varchar as o_orderkey, case when o_orderkey % 4 <> 1 then o_orderdate::date end as first_date,
  case when o_orderkey = 0 then 'n/a' else strftime(o_orderdate, '%Y-%m-%d') end as first_text from orders
"""

_SUFFIXES = ["_DATE", "update", "_dated", "Date", "", "_at"]


def date_like_names(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part")
    named = [F.concat(F.col("p_name"), F.lit(s)) for s in _SUFFIXES] + [
        F.element_at(F.array(F.lit("DOB"), F.lit("dateOfBirth"), F.lit("dobs")), (F.col("p_partkey") % 3 + 1).cast("int"))
    ]
    names = part.select("p_partkey", F.explode(F.array(*named)).alias("column_name"))
    return profile.date_like_columns(names)


DATE_LIKE_NAMES = """
select p_partkey, p_name || s as column_name from part, (values ('_DATE'), ('update'), ('Date')) v(s)
union all select p_partkey, case p_partkey % 3 when 0 then 'DOB' else 'dateOfBirth' end from part where p_partkey % 3 < 2
"""


def guarded_date(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = F.when(key % 7 == 0, "2024-02-30").when(key % 7 == 1, "soon").when(key % 7 == 2, "2024-1-5").otherwise(fx.day("o_orderdate"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", values.guarded_date(raw).alias("value"))


GUARDED_DATE = """
with v as (select o_orderkey, case o_orderkey % 7 when 0 then '2024-02-30' when 1 then 'soon' when 2 then '2024-1-5'
  else strftime(o_orderdate, '%Y-%m-%d') end as raw from orders)
select o_orderkey, case when regexp_matches(raw, '^\\d{4}-\\d{2}-\\d{2}$') then try_cast(raw as date)::varchar else raw end as value
from v
"""


def detect_dates(spark, sf_dir):
    key, day = F.col("o_orderkey"), fx.day("o_orderdate")
    flat = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("always"),
        F.when(key % 20 == 0, "late").otherwise(day).alias("mostly"),
        F.when(key % 10 == 0, "late").otherwise(day).alias("often"),
        F.when(key % 3 == 0, day).alias("some_null"),
        F.lit(None).cast("string").alias("never"),
        F.col("o_orderpriority"),
    )
    shares = profile.date_shares(flat, values.DATE_PATTERN, shape.MIN_DATE_SHARE)
    lost = shape.detect_dates(flat)
    kept = lost.agg(*[F.count(c).alias(c) for c in lost.columns[1:]])
    kept = kept.unpivot([], list(kept.columns), "column_name", "kept")
    types = F.create_map(*[F.lit(x) for pair in lost.dtypes for x in pair])
    return shares.join(kept, "column_name").withColumn("type", types[F.col("column_name")])


DETECT_DATES = """
with f as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as d, o_orderpriority from orders),
c as (
  select 'always' as column_name, d as v from f
  union all select 'mostly', case when o_orderkey % 20 = 0 then 'late' else d end from f
  union all select 'often', case when o_orderkey % 10 = 0 then 'late' else d end from f
  union all select 'some_null', case when o_orderkey % 3 = 0 then d end from f
  union all select 'never', null from f
  union all select 'o_orderpriority', o_orderpriority from f),
s as (select column_name, count(v) as non_null, count(*) filter (regexp_matches(v, '^\\d{4}-\\d{2}-\\d{2}$')) as hits from c group by 1),
w as (select *, coalesce(hits / nullif(non_null, 0) >= 0.95::double, false) as is_date from s)
select column_name, non_null, hits, is_date, case when is_date then hits else non_null end as kept,
  case when is_date then 'date' else 'string' end as type from w
"""


def normalize_ts(spark, sf_dir):
    sent = F.when(F.col("event_id") % 9 == 0, "no time").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+02:00"))
    )
    flat = fx.table(spark, sf_dir, "events").select("event_id", sent.alias("ingestion_timestamp"))
    done = shape.normalize_ingestion_timestamp(flat)
    return done.select("event_id", (F.unix_millis("ingestion_timestamp")).alias("millis"))


NORMALIZE_TS = """
select event_id, case when event_id % 9 <> 0 then (floor(epoch(ts))::bigint - 7200) * 1000 end as millis from events
"""


def stamp_ts(spark, sf_dir):
    flat = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit("2001-01-01T00:00:00.9Z").alias("ingestion_timestamp")
    )
    now = shape.stamp_ingestion(flat).select("o_orderkey", F.col("ingestion_timestamp").alias("now"))
    sent = shape.stamp_ingestion(flat, "envelope")
    past = F.unix_millis("ingestion_timestamp")
    return now.select("o_orderkey", (F.year("now") > 2001).alias("is_now"), F.lit("processing").alias("mode")).unionByName(
        sent.select("o_orderkey", (past != 978307200000).alias("is_now"), F.lit("envelope").alias("mode"))
    )


STAMP_TS = """
select o_orderkey, true as is_now, 'processing' as mode from orders union all select o_orderkey, false, 'envelope' from orders
"""

# Logical labels with the Spark type, the exact and the fragment RDBMS type.
_LOGICAL = [
    ("Boolean", "boolean", "BOOLEAN", "BOOLEAN"),
    (" bool ", "boolean", "BOOLEAN", "BOOLEAN"),
    ("BIGINT", "bigint", "BIGINT", "BIGINT"),
    ("long", "bigint", "TEXT", "BIGINT"),
    ("Integer", "int", "INTEGER", "INTEGER"),
    ("point", "int", "TEXT", "INTEGER"),
    ("interval", "int", "TEXT", "INTEGER"),
    ("float", "double", "DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("real", "double", "TEXT", "DOUBLE PRECISION"),
    ("decimal(10,2)", "decimal(38,10)", "TEXT", "NUMERIC"),
    ("numeric", "decimal(38,10)", "TEXT", "NUMERIC"),
    ("date", "date", "DATE", "DATE"),
    ("datetime", "timestamp", "TEXT", "TIMESTAMP"),
    ("TimestampTZ", "timestamp", "TIMESTAMPTZ", "TIMESTAMP"),
    ("time", "timestamp", "TEXT", "TIMESTAMP"),
    ("varchar", "string", "TEXT", "TEXT"),
    ("text", "string", "TEXT", "TEXT"),
    ("", "string", "TEXT", "TEXT"),
]
# Spark types with their RDBMS column type, plain and wide.
_PHYSICAL = [
    ("smallint", "INTEGER", "BIGINT"),
    ("int", "INTEGER", "BIGINT"),
    ("bigint", "BIGINT", "BIGINT"),
    ("float", "DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("double", "DOUBLE PRECISION", "DOUBLE PRECISION"),
    ("decimal(18,2)", "NUMERIC(18,2)", "TEXT"),
    ("boolean", "BOOLEAN", "TEXT"),
    ("date", "DATE", "TEXT"),
    ("timestamp", "TIMESTAMP", "TIMESTAMP"),
    ("string", "TEXT", "TEXT"),
    ("array<int>", "TEXT", "TEXT"),
]


def _labelled(spark, sf_dir, known):
    """A type label per line item, from its keys."""
    index = (F.col("l_partkey") + F.col("l_linenumber")) % len(known) + 1
    label = F.element_at(F.array(*[F.lit(k[0]) for k in known]), index.cast("int"))
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"))


def _labelled_sql(known, *names):
    rows = ", ".join("(" + str(i) + ", " + ", ".join(f"'{v}'" for v in k) + ")" for i, k in enumerate(known))
    return (
        f"select l_orderkey, l_linenumber, t.* exclude (i) from lineitem join (values {rows}) t(i, label, "
        f"{', '.join(names)}) on (l_partkey + l_linenumber) % {len(known)} = t.i"
    )


def logical_to_spark(spark, sf_dir):
    return _labelled(spark, sf_dir, _LOGICAL).withColumn("spark_type", labels.spark_type(F.col("label")))


def logical_to_rdbms(spark, sf_dir):
    return _labelled(spark, sf_dir, _LOGICAL).withColumns(
        {"exact": labels.rdbms_type(F.col("label")), "fragment": labels.rdbms_type(F.col("label"), "fragment")}
    )


def rdbms_types(spark, sf_dir):
    return _labelled(spark, sf_dir, _PHYSICAL).withColumns(
        {"ddl": labels.rdbms_ddl_type(F.col("label")), "wide": labels.rdbms_ddl_type(F.col("label"), "wide")}
    )


QUERIES = {
    "infer_types": (infer_types, INFER_TYPES),
    "typed_frame": (typed_frame, TYPED_FRAME),
    "date_by_first": (date_by_first, DATE_BY_FIRST),
    "date_like_names": (date_like_names, DATE_LIKE_NAMES),
    "guarded_date": (guarded_date, GUARDED_DATE),
    "detect_dates": (detect_dates, DETECT_DATES),
    "normalize_ts": (normalize_ts, NORMALIZE_TS),
    "stamp_ts": (stamp_ts, STAMP_TS),
    "logical_to_spark": (
        logical_to_spark, _labelled_sql([k[:2] for k in _LOGICAL], "spark_type"),
    ),
    "logical_to_rdbms": (
        logical_to_rdbms, _labelled_sql([(k[0], k[2], k[3]) for k in _LOGICAL], "exact", "fragment"),
    ),
    "rdbms_types": (rdbms_types, _labelled_sql(_PHYSICAL, "ddl", "wide")),
}
