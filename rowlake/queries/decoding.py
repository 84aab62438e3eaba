"""Queries for sources, decoding and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake.queries import fixtures as fx
from rowlake.sources import envelope, messages


def bounded_drain(spark, sf_dir):
    """Half of what waits behind the first quarter, on a log with gaps between its offsets."""
    gaps = fx.orders_messages(spark, sf_dir).withColumn("offset", F.col("offset") * 3)
    log = fx.logged(spark, gaps)
    committed = messages.offset_bounds(log).select("partition", F.floor(F.col("end_offset") / 4).alias("committed"))
    waiting = messages.bounded_drain(log, committed=committed).count()
    drained = messages.bounded_drain(log, max_messages=waiting // 2, committed=committed)
    return drained.select("partition", "offset", F.json_array_length(F.get_json_object("value", "$.data")).alias("rows"))


BOUNDED_DRAIN = """
with m as (
  select ((o_orderkey // 20) % 4)::int as "partition", 3 * (o_orderkey // 80) as "offset", count(*) as n
  from orders group by all),
e as (select "partition", (max("offset") + 1) // 4 as committed from m group by all),
open as (
  select m.*, row_number() over (partition by "partition" order by m."offset") as r,
    count(*) over (partition by "partition") as waiting
  from m join e using ("partition") where "offset" >= committed),
shares as (
  select "partition", sum(waiting) over () // 2 as most, count(*) over () as parts,
    row_number() over (order by waiting, "partition") as k
  from (select distinct "partition", waiting from open))
select "partition", "offset", n::int as rows from open join shares using ("partition")
where r <= most // parts + (k <= most % parts)::int
"""


def decode_envelope(spark, sf_dir):
    decoded = envelope.decode_envelope(fx.document_messages(spark, sf_dir))
    row = envelope.explode_rows(decoded)
    return row.select(
        "filename", "malformed", F.col("row")["doc_id"].alias("doc_id"), F.col("row")["text"].alias("text"),
        F.col("row")["lang"].alias("lang"),
    )


DECODE_ENVELOPE = """
select 'documents.json' as filename, false as malformed, doc_id::varchar as doc_id, text, lang from documents
"""


def decode_typed(spark, sf_dir):
    good = fx.event_messages(spark, sf_dir)
    bad = good.select("partition", "offset", F.concat(F.lit("{"), F.col("value")).alias("value"))
    listless = good.select("partition", "offset", F.lit('{"filename":"b.csv","data":{"a":1}}').alias("value"))
    rows = envelope.explode_rows(envelope.decode_envelope_typed(good.union(bad).union(listless)))
    entry = rows.select("row.event_id", "row.value", "row.is_error", "row.props")
    return entry.select(
        F.try_variant_get("event_id", "$", "bigint").alias("event_id"),
        F.try_variant_get("value", "$", "double").alias("value"),
        F.try_variant_get("is_error", "$", "boolean").alias("is_error"),
        F.try_variant_get("props", "$.k", "bigint").alias("k"),
        F.schema_of_variant("event_id").alias("id_type"),
    )


DECODE_TYPED = """
select event_id, value, event_type = 'error' as is_error,
  regexp_extract(props, '([0-9]+)', 1)::bigint as k, 'BIGINT' as id_type from events
"""


def explode_rows(spark, sf_dir):
    log = fx.orders_messages(spark, sf_dir)
    emptied = log.withColumn(
        "value",
        F.when(
            (F.col("offset") * 4 + F.col("partition")) % 7 == 0,
            F.regexp_replace("value", r'"data":\[.*\]', '"data":[]'),
        ).otherwise(F.col("value")),
    )
    rows = envelope.explode_rows(envelope.decode_envelope(emptied))
    return rows.groupBy("partition", "filename").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("row").isNull()).alias("null_rows"),
        F.sum("pos").alias("positions"),
    )


EXPLODE_ROWS = """
with r as (
  select ((o_orderkey // 20) % 4)::int as "partition", o_orderkey // 20 as g, o_orderkey % 20 as pos from orders),
kept as (select "partition", g, pos from r where g % 7 <> 0
  union all select distinct "partition", g, null from r where g % 7 = 0)
select "partition", 'C:\\landing\\Orders.csv' as filename, count(*) as rows, count(*) - count(pos) as null_rows,
  sum(pos)::bigint as positions from kept group by 1
"""


def row_or_data(spark, sf_dir):
    batch = envelope.decode_envelope(fx.customer_messages(spark, sf_dir))
    exploded = envelope.accept_row_or_data(batch)
    again = envelope.accept_row_or_data(exploded)
    return (
        exploded.withColumn("shape", F.lit("data")).unionByName(again.withColumn("shape", F.lit("row")))
        .select("shape", F.col("row")["c_custkey"].alias("c_custkey"), "pos")
    )


ROW_OR_DATA = """
select shape, c_custkey::varchar as c_custkey, (c_custkey % 20)::int as pos
from customer, (values ('data'), ('row')) s(shape)
"""


def propagate_ts(spark, sf_dir):
    fields = {**fx.ORDERS, "ingestion_timestamp": "'never'", "filename": "'row.csv'"}
    log = fx.messages(fx.table(spark, sf_dir, "orders"), "o_orderkey", fx.ORDERS_FILE, fields)
    rows = envelope.explode_rows(envelope.decode_envelope(log))
    stamped = envelope.stamp_file_metadata(envelope.propagate_ingestion_timestamp(rows))
    return stamped.select(
        F.col("row")["o_orderkey"].alias("o_orderkey"),
        F.unix_timestamp(F.try_to_timestamp(F.col("row")["ingestion_timestamp"])).alias("sent"),
        F.col("row")["filename"].alias("filename"),
        F.col("row")["data_format"].alias("data_format"),
        F.size("row").alias("keys"),
    )


PROPAGATE_TS = f"""
select o_orderkey::varchar as o_orderkey, {fx.sent_at_sql('o_orderkey')} as sent, 'C:\\landing\\Orders.csv' as filename,
  'csv' as data_format, 5 + (o_orderkey % 3 <> 0)::int + 3 as keys from orders
"""

QUERIES = {
    "bounded_drain": (bounded_drain, BOUNDED_DRAIN),
    "decode_envelope": (decode_envelope, DECODE_ENVELOPE),
    "decode_typed": (decode_typed, DECODE_TYPED),
    "explode_rows": (explode_rows, EXPLODE_ROWS),
    "row_or_data": (row_or_data, ROW_OR_DATA),
    "propagate_ts": (propagate_ts, PROPAGATE_TS),
}
