"""Queries for whole ingestion flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.plans import bulk as bulk_plans
from rowlake.plans.bulk import (
    bulk_ingest,
    committed_offsets,
    drain_in_steps,
    log_backlog,
    typed_ingest as ingest_typed,
)
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed
from rowlake.plans.fanout import Limits, fan_out, rejects_of
from rowlake.plans.history import drifted, merged_profile as merge_profiles
from rowlake.sources.messages import MAX_OFFSETS_PER_TRIGGER, replay_stream
from rowlake.sources.offsets import offset_stream as open_offsets
from rowlake.streaming.backlog import BacklogListener, log_ends
from rowlake.streaming.ingest import drain_then_stream as start_after_drain, drained, stream_ingest as start_stream


def stream_ingest(spark, sf_dir):
    tables = ("orders", "customer", "lineitem")
    path = fx.written_log(spark, fx.dealt(spark, sf_dir, fx.sales_messages(spark, sf_dir), tables, 6))
    lake = fx.new_lake(spark)
    start_stream(
        replay_stream(spark, path, max_files_per_trigger=3), lake, workspace.new_folder(spark, "checkpoint"), drain=True
    ).awaitTermination()
    return fx.sales_content(lake.scan)


def offset_stream(spark, sf_dir):
    """A message per order, taken by offsets: two runs from one checkpoint, the log growing in between."""
    log = fx.single_messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, fx.ORDERS)
    half = F.lit(log.count() // 2 // fx.LOG_PARTITIONS)
    path, checkpoint = workspace.new_folder(spark, "log"), workspace.new_folder(spark, "checkpoint")
    lake, taken = fx.new_lake(spark), []
    for part in (F.col("offset") < half, F.col("offset") >= half):
        fx.append_segments(log.where(part), path)
        query = drained(start_stream(open_offsets(spark, path), lake, checkpoint, trigger_interval="0 seconds"))
        taken += [p["numInputRows"] for p in query.recentProgress]
    within = max(taken) <= MAX_OFFSETS_PER_TRIGGER and sum(taken) == log.count()
    return lake.scan("orders").select(*fx.ORDERS).withColumn("within", F.lit(within))


# Offsets a trigger of the query below takes.
BACKLOG_STEP = 4000


def stream_backlog(spark, sf_dir):
    """What is left of a log after each trigger of the stream that reads it, down to nothing."""
    log = fx.single_messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, {"o_orderkey": "cast(o_orderkey as string)"})
    path = workspace.new_folder(spark, "log")
    fx.append_segments(log, path)
    listener = BacklogListener(log_ends(path), kept_triggers=None)
    spark.streams.addListener(listener)
    try:
        stream = start_stream(
            open_offsets(spark, path, BACKLOG_STEP), fx.new_lake(spark), workspace.new_folder(spark, "checkpoint"), trigger_interval="0 seconds"
        )
        listener.settled(drained(stream))
    finally:
        spark.streams.removeListener(listener)
    by_trigger = listener.frame(spark).groupBy("batch_id").agg(F.sum("backlog").alias("backlog"), F.sum("end_offset").alias("end_offset"))
    return by_trigger


STREAM_BACKLOG = f"""
with n as (select count(*) as n from orders)
select i as batch_id, greatest(n - (i + 1) * {BACKLOG_STEP}, 0)::bigint as backlog, n::bigint as end_offset
from n, range((select count(*) from orders)) r(i) where i * {BACKLOG_STEP} < n
"""


def bulk(spark, sf_dir):
    lake = fx.new_lake(spark)
    log = fx.logged(spark, fx.sales_messages(spark, sf_dir))
    bulk_ingest(log, lake, "sales")
    return fx.sales_content(lake.scan)


def bulk_ingest_staged(spark, sf_dir):
    """The same drain through a written table, as for logs of any size."""
    lake = fx.new_lake(spark)
    bulk_ingest(fx.logged(spark, fx.sales_messages(spark, sf_dir)), lake, "sales", staging="table")
    return fx.sales_content(lake.scan)


def topic_backlog(spark, sf_dir):
    """What is left after a drain of half of the log."""
    log = fx.logged(spark, fx.part_messages(spark, sf_dir, 0))
    lake = fx.new_lake(spark)
    bulk_ingest(log, lake, "half", max_messages=log.count() // 2)
    committed = committed_offsets(lake, "half")
    return log_backlog(log, committed).withColumn("read_back", F.lit(lake.scan("part").count()).cast("bigint"))


TOPIC_BACKLOG = """
with m as (select (p_partkey // 20) % 4 as p, p_partkey // 80 as o, count(*) as n from part group by all),
r as (select *, row_number() over (partition by p order by o) as r, count(*) over (partition by p) as waiting from m),
shares as (
  select p, sum(waiting) over () as total, count(*) over () as parts, row_number() over (order by waiting, p) as k
  from (select distinct p, waiting from r))
select (max(total) - max(total) // 2)::bigint as backlog,
  (sum(n) filter (r <= (total // 2) // parts + (k <= (total // 2) % parts)::int))::bigint as read_back
from r join shares using (p)
"""


def drain_then_stream(spark, sf_dir):
    """Drain what is there, then stream what arrives, from one checkpoint."""
    path = fx.written_log(spark, fx.orders_messages(spark, sf_dir))
    lake = fx.new_lake(spark)
    query = start_after_drain(replay_stream(spark, path), lake, workspace.new_folder(spark, "checkpoint"))
    try:
        late = fx.customer_messages(spark, sf_dir).unionByName(fx.lineitem_messages(spark, sf_dir))
        late.write.mode("append").parquet(path)
        query.processAllAvailable()
    finally:
        query.stop()
    return fx.sales_content(lake.scan)


def drain_steps(spark, sf_dir):
    """The log in several drains, each from where the last one ended."""
    log = fx.logged(spark, fx.customer_messages(spark, sf_dir))
    lake = fx.new_lake(spark)
    steps = drain_in_steps(log, lake, "steps", step=-(-log.count() // 3))
    read = lake.scan("customer").select("c_custkey", "c_name")
    return read.withColumn("steps", F.lit(len(steps)))


def replay_idempotent(spark, sf_dir):
    """The same batch twice under one id, then another batch."""
    lake = fx.new_lake(spark)
    for _ in range(2):
        fan_out(routed(fx.orders_messages(spark, sf_dir)), lake, "replay", 0)
    fan_out(routed(fx.orders_messages(spark, sf_dir)), lake, "replay", 1)
    return lake.scan("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys")
    )


REPLAY_IDEMPOTENT = """
select o_orderstatus, 2 * count(*) as rows, count(*) as keys from orders group by 1
"""

def typed_ingest(spark, sf_dir):
    """A log with JSON types, stored as text and dates, under the type of each first value."""
    lake = fx.new_lake(spark)
    ingest_typed(fx.logged(spark, fx.event_messages(spark, sf_dir)), lake, "events", 0)
    return lake.scan("events").select("event_id", "is_error", "seen")


TYPED_INGEST = """
select event_id::varchar as event_id, (event_type = 'error')::varchar as is_error,
  case when event_id % 8 <> 3 then ts::date end as seen from events
"""


def typed_tables(spark, sf_dir):
    """A table per kind of event, all typed in one pass; the values of one kind are text now and then."""
    file = F.concat(F.lit("/in/"), "event_type", F.lit(".json"))
    rows = fx.table(spark, sf_dir, "events").withColumn("data", F.array(fx.row_of(fx.EVENTS)))
    key = F.col("event_id")
    value = F.regexp_replace(fx.envelope(file, fx.sent_at(key), F.col("data")), '"value":', '"amount":')
    value = F.when(F.expr("event_type = 'click' and event_id % 7 = 0"), F.regexp_replace(value, '"amount":[^,]*', '"amount":"n/a"')).otherwise(value)
    log = rows.select((key % 4).cast("int").alias("partition"), key.alias("offset"), value.alias("value"))
    lake = fx.new_lake(spark)
    bulk_ingest(fx.logged(spark, log), lake, "typed", typed=True, staging="table")
    frames = [lake.scan(t).withColumn("table_name", F.lit(t)) for t in sorted(lake.table_names())]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    number = F.col("amount").try_cast("double")
    return out.select("table_name", "event_id", "is_error", "seen", number.alias("amount"), (F.col("amount") == "n/a").alias("odd"))


TYPED_TABLES = """
select event_type as table_name, event_id::varchar as event_id, (event_type = 'error')::varchar as is_error,
  case when event_id % 8 <> 3 then ts::date end as seen, case when not odd then value end as amount, odd
from (select *, event_type = 'click' and event_id % 7 = 0 as odd from events)
"""


# Dates that turn into words after the first third of the orders, and a column that is blank until then.
_DRIFT = {
    "o_orderkey": "cast(o_orderkey as string)",
    "o_when": "if(o_orderkey % 3 = 0, date_format(o_orderdate, 'yyyy-MM-dd'), if(o_orderkey % 2 = 0, 'soon', null))",
    "o_late": "if(o_orderkey % 3 = 0, '', date_format(o_orderdate, 'yyyy-MM-dd'))",
    "o_word": "if(o_orderkey % 3 = 0 and o_orderkey % 2 = 0, o_orderstatus, if(o_orderkey % 3 = 0, '', date_format(o_orderdate, 'yyyy-MM-dd')))",
}


def merged_profile(spark, sf_dir):
    """A log in three batches, the last one first and one run twice: their profiles are that of one batch."""
    orders = fx.table(spark, sf_dir, "orders")
    log = fx.logged(spark, fx.single_messages(orders, "o_orderkey", fx.ORDERS_FILE, _DRIFT, partitions=3))
    lake = fx.new_lake(spark)
    for batch_id in (2, 0, 1, 0):
        fan_out(routed(log.where(F.col("partition") == batch_id)), lake, "orders", batch_id, mode="bulk", history=lake)
    drift = drifted(lake).select("column_name", F.lit(True).alias("drifted"))
    return merge_profiles(lake).join(drift, "column_name", "left").select(
        "table_name", "column_name", "non_null", "date_hits", "first_is_date", "verdict", F.coalesce("drifted", F.lit(False)).alias("drifted")
    )


MERGED_PROFILE = """
with v as (
  select o_orderkey % 3 as p, o_orderkey // 3 as o, unnest(['o_orderkey', 'o_when', 'o_late', 'o_word']) as column_name, unnest([
    o_orderkey::varchar, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y-%m-%d') when o_orderkey % 2 = 0 then 'soon' end,
    case when o_orderkey % 3 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end,
    case when o_orderkey % 3 <> 0 then strftime(o_orderdate, '%Y-%m-%d') when o_orderkey % 2 = 0 then o_orderstatus end]) as x
  from orders),
m as (
  select column_name, count(x) as non_null, count(*) filter (x like '____-__-__') as date_hits,
    arg_min(x like '____-__-__', (p, o)) filter (x is not null) as first_is_date from v group by 1),
d as (select *, case when first_is_date or date_hits >= 0.95 * non_null then 'date' else 'string' end as verdict from m)
select 'orders' as table_name, *, column_name in ('o_when', 'o_word', 'o_late') and
  case column_name when 'o_when' then 'string' else 'date' end <> verdict as drifted from d
"""


def dead_letters(spark, sf_dir):
    """A message per order, some broken and some without rows: a drain, run again after a failure, and a stream of the rest."""
    single = fx.single_messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, fx.ORDERS, partitions=2)
    order = F.col("offset") * 2 + F.col("partition")
    value = F.when(order % 7 == 0, F.concat(F.lit('{"filename": broken '), order)).when(
        order % 7 == 1, F.concat(F.lit('{"filename":"Orders.csv","rows":'), order, F.lit("}"))
    ).otherwise(F.col("value"))
    log = fx.logged(spark, single.withColumn("value", value))
    lake, first, checkpoint = fx.new_lake(spark), F.col("partition") == 0, workspace.new_folder(spark, "checkpoint")
    commit = bulk_plans.commit_offsets
    try:
        bulk_plans.commit_offsets = lambda *_: (_ for _ in ()).throw(OSError("lost"))
        bulk_ingest(log.where(first), lake, "orders", dead_letters="dead_letters")
    except OSError:
        pass
    finally:
        bulk_plans.commit_offsets = commit
    bulk_ingest(log.where(first), lake, "orders", dead_letters="dead_letters")
    source = replay_stream(spark, fx.written_log(spark, log.where(~first)))
    start_stream(source, lake, checkpoint, drain=True, dead_letters="dead_letters").awaitTermination()
    rows = F.lit(lake.scan("orders").where("o_orderkey is not null").count()).cast("bigint")
    return lake.scan("dead_letters").select("log_partition", "log_offset", "reason", "value").withColumn("rows", rows)


DEAD_LETTERS = """
with o as (select o_orderkey as k, o_orderkey % 2 as p, o_orderkey // 2 as o from orders)
select p::int as log_partition, o as log_offset, case k % 7 when 0 then 'malformed' else 'no list' end as reason,
  case k % 7 when 0 then '{"filename": broken ' || k else '{"filename":"Orders.csv","rows":' || k || '}' end as value,
  (select count(*) from o where k % 7 > 1) as rows
from o where k % 7 = 0 or (k % 7 = 1 and p = 0)
"""


def two_streams(spark, sf_dir):
    """Two streams, each with a checkpoint of its own, into the same tables of one lake."""
    lake = fx.new_lake(spark)
    for part in (0, 1):
        log = fx.orders_messages(spark, sf_dir).where(F.col("partition") % 2 == part)
        source = replay_stream(spark, fx.written_log(spark, log))
        start_stream(source, lake, workspace.new_folder(spark, "checkpoint"), drain=True).awaitTermination()
    return lake.scan("orders").select(*fx.ORDERS)


def two_logs(spark, sf_dir):
    """Two logs with the same offsets, each under its name, into the same table of one lake."""
    lake = fx.new_lake(spark)
    log = fx.orders_messages(spark, sf_dir)
    for name in ("north", "south"):
        bulk_ingest(fx.logged(spark, log), lake, name, log_name=f"topic {name}")
    return lake.scan("orders").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("rows"))


def many_tables(spark, sf_dir):
    """A table per supplier, more of them than a page of the profile holds."""
    key, fields = F.col("s_suppkey"), {"s_suppkey": "cast(s_suppkey as string)", "s_name": "s_name"}
    file = F.concat(F.lit("/in/s"), key, F.lit(".csv"))
    log = fx.table(spark, sf_dir, "supplier").select(
        (key % 4).cast("int").alias("partition"), key.alias("offset"),
        fx.envelope(file, fx.sent_at(key), F.array(fx.row_of(fields))).alias("value"),
    )
    lake = fx.new_lake(spark)
    bulk_ingest(fx.logged(spark, log), lake, "suppliers", limits=Limits(page_tables=7), staging="table")
    stored = spark.read.parquet(f"{lake.root}/*/g0/batch=*")
    return stored.select("s_suppkey", "s_name").withColumn("tables", F.lit(len(lake.table_names())))


def rejects(spark, sf_dir):
    """Text of a column that was first seen as a date is kept beside the table."""
    lake = fx.new_lake(spark)
    fan_out(routed(fx.orders_messages(spark, sf_dir)), lake, "first", 0)
    words = {"o_orderkey": "cast(o_orderkey as string)", "o_orderdate": "concat('week of ', date_format(o_orderdate, 'yyyy-MM-dd'))"}
    log = fx.messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, words)
    fan_out(routed(log), lake, "second", 0, on_type_mismatch="reject")
    lost = lake.scan("orders").where("o_orderdate is null").count()
    return lake.scan(rejects_of("orders")).select("partition", "offset", "pos", "column_name", "value").withColumn("lost", F.lit(lost).cast("bigint"))


REJECTS = """
select ((o_orderkey // 20) % 4)::int as "partition", o_orderkey // 80 as "offset", (o_orderkey % 20)::int as pos,
  'o_orderdate' as column_name, 'week of ' || strftime(o_orderdate, '%Y-%m-%d') as value, count(*) over () as lost
from orders
"""


QUERIES = {
    "stream_ingest": (stream_ingest, fx.sales_sql()),
    "offset_stream": (
        offset_stream, fx.select_sql(fx.ORDERS_SQL | {"o_orderdate": "o_orderdate::date", "within": "true"}, "orders"),
    ),
    "stream_backlog": (stream_backlog, STREAM_BACKLOG),
    "bulk_ingest": (bulk, fx.sales_sql()),
    "bulk_ingest_staged": (bulk_ingest_staged, fx.sales_sql()),
    "typed_ingest": (typed_ingest, TYPED_INGEST),
    "typed_tables": (typed_tables, TYPED_TABLES),
    "merged_profile": (merged_profile, MERGED_PROFILE),
    "dead_letters": (dead_letters, DEAD_LETTERS),
    "two_streams": (two_streams, fx.select_sql(fx.ORDERS_SQL | {"o_orderdate": "o_orderdate::date"}, "orders")),
    "two_logs": (two_logs, "select o_orderkey::varchar as o_orderkey, 2::bigint as rows from orders"),
    "many_tables": (
        many_tables, "select s_suppkey::varchar as s_suppkey, s_name, (count(*) over ())::int as tables from supplier",
    ),
    "rejects": (rejects, REJECTS),
    "topic_backlog": (topic_backlog, TOPIC_BACKLOG),
    "drain_then_stream": (drain_then_stream, fx.sales_sql()),
    "drain_steps": (drain_steps, "select c_custkey::varchar as c_custkey, c_name, 3 as steps from customer"),
    "replay_idempotent": (replay_idempotent, REPLAY_IDEMPOTENT),
}
