"""Queries for routing and shaping rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake.operators import profile, shape
from rowlake.plans.fanout import fan_out
from rowlake.queries import fixtures as fx
from rowlake.sources.envelope import decode_envelope, explode_rows


def routed(log):
    return shape.route_physical(decode_envelope(log))


def route_by_table(spark, sf_dir):
    log = fx.orders_messages(spark, sf_dir, drop_row="o_orderkey % 11 = 0").unionByName(
        fx.part_messages(spark, sf_dir)
    )
    rows = shape.route_by_table(decode_envelope(log))
    return rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.size("row") == 0).alias("empty_rows")
    )


ROUTE_BY_TABLE = """
select 'Orders' as table_name, count(*) as rows, count(*) filter (o_orderkey % 11 = 0) as empty_rows from orders
union all select 'public.part', count(*), 0 from part
"""


def materialized_columns(spark, sf_dir):
    log = fx.orders_messages(spark, sf_dir).unionByName(fx.part_messages(spark, sf_dir))
    return profile.materialized_columns(routed(log))


MATERIALIZED_COLUMNS = " union all ".join(
    [f"select 'orders' as table_name, '{c}' as column_name where exists (select 1 from orders)" for c in fx.ORDERS if c != "o_custkey"]
    + ["select 'orders', 'o_custkey' where exists (select 1 from orders where o_orderkey % 3 <> 0)"]
    + [f"select 'part', '{c}' where exists (select 1 from part)" for c in fx.PART if c != "p_brand"]
    + ["select 'part', 'p_brand' where exists (select 1 from part where p_partkey % 3 <> 0)"]
)


def normalize_rows(spark, sf_dir):
    return shape.normalize_rows(routed(fx.orders_messages(spark, sf_dir)), fx.ORDERS)


def wide_rows(spark, sf_dir):
    """Rows of 63, 64 and 65 keys, one of them named like Spark's column for what it cannot parse."""
    out = None
    for n in (63, 64, 65):
        keys = [f"k{i}" for i in range(n - 1)]
        pairs = [x for i, k in enumerate(keys) for x in (F.lit(k), (F.col("l_linenumber") + i).cast("string"))]
        row = F.create_map(*pairs, F.lit("_corrupt_record"), fx.text("l_orderkey"))
        rows = fx.table(spark, sf_dir, "lineitem").select(row.alias("row"))
        wide = shape.normalize_rows(rows, [*keys, "_corrupt_record"])
        wide = wide.select(F.lit(n).alias("keys"), "_corrupt_record", "k0", F.col(keys[-1]).alias("last"))
        out = wide if out is None else out.union(wide)
    return out


WIDE_ROWS = """
select n::int as keys, l_orderkey::varchar as _corrupt_record, l_linenumber::varchar as k0, (l_linenumber + n - 2)::varchar as last
from lineitem, (values (63), (64), (65)) v(n)
"""


def _flat_orders(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"),
        (F.col("o_orderstatus") == "F").alias("finished"),
        F.lit("csv").alias("data_format"),
        F.lit("orders.csv").alias("filename"),
        F.lit("a").alias("source_filename"),
        F.lit("b").alias("source_data_format"),
    )


def drop_technical(spark, sf_dir):
    return shape.drop_technical(_flat_orders(spark, sf_dir), with_filename=True)


DROP_TECHNICAL = """
select o_orderkey, o_totalprice::decimal(18,2) as o_totalprice, o_orderdate::date as o_orderdate,
  o_orderstatus = 'F' as finished from orders
"""


def final_projection(spark, sf_dir):
    flat = shape.stamp_ingestion(shape.drop_technical(_flat_orders(spark, sf_dir), with_filename=True))
    final = shape.final_projection(flat)
    return final.drop("ingestion_timestamp").withColumn("column_order", F.lit(",".join(final.columns)))


FINAL_PROJECTION = """
select *, 'finished,o_orderdate,o_orderkey,o_totalprice,ingestion_timestamp' as column_order from ({})
""".format(DROP_TECHNICAL)


def stringify(spark, sf_dir):
    return shape.stringify(shape.drop_technical(_flat_orders(spark, sf_dir), with_filename=True))


STRINGIFY = """
select o_orderkey::varchar as o_orderkey, o_totalprice::decimal(18,2)::varchar as o_totalprice,
  o_orderdate::date as o_orderdate, (o_orderstatus = 'F')::varchar as finished from orders
"""


def skip_rules(spark, sf_dir):
    log = fx.orders_messages(spark, sf_dir, drop_row="o_orderkey % 11 = 0")
    keyless = fx.part_messages(spark, sf_dir).select(
        "partition", "offset", F.lit('{"filename":"empty.csv","data":[{},null]}').alias("value")
    )
    lake = fx.new_lake(spark)
    fan_out(routed(log.unionByName(keyless)), lake, "skip", 0)
    orders = lake.scan("orders").groupBy(F.lit("orders").alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("o_orderkey").isNull()).alias("null_rows")
    )
    return orders.withColumn("tables", F.lit(len(lake.table_names())).cast("bigint"))


SKIP_RULES = """
select 'orders' as table_name, count(*) as rows, count(*) filter (o_orderkey % 11 = 0) as null_rows,
  1::bigint as tables from orders
"""


def flat_first_row(spark, sf_dir):
    batch = explode_rows(decode_envelope(fx.orders_messages(spark, sf_dir)))
    flat = shape.flat_first_row(batch)
    return flat.withColumn("ingestion_timestamp", F.unix_timestamp("ingestion_timestamp"))


# The first row has key 0, so it has no o_custkey.
FLAT_FIRST_ROW = f"""
select 'C:\\landing\\Orders.csv' as filename, 'csv' as data_format, {fx.sent_at_sql('o_orderkey')} as ingestion_timestamp,
  o_orderkey::varchar as o_orderkey, o_orderstatus, o_totalprice::decimal(18,2)::varchar as o_totalprice,
  o_orderdate::date as o_orderdate, case when o_orderkey % 5 = 0 then '' else o_orderpriority end as o_orderpriority
from orders
"""

QUERIES = {
    "wide_rows": (wide_rows, WIDE_ROWS),
    "route_by_table": (route_by_table, ROUTE_BY_TABLE),
    "materialized_columns": (materialized_columns, MATERIALIZED_COLUMNS),
    "normalize_rows": (normalize_rows, fx.select_sql(fx.ORDERS_SQL, "orders")),
    "drop_technical": (drop_technical, DROP_TECHNICAL),
    "final_projection": (final_projection, FINAL_PROJECTION),
    "stringify": (stringify, STRINGIFY),
    "skip_rules": (skip_rules, SKIP_RULES),
    "flat_first_row": (flat_first_row, FLAT_FIRST_ROW),
}
