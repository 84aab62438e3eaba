"""Queries for lake tables and plain sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowlake import workspace
from rowlake.plans.fanout import fan_out, write_frame, write_split_by_filename, written_frame
from rowlake.queries import fixtures as fx
from rowlake.queries.shaping import routed
from rowlake.sources.lake import store_parquet, write_parquet
from rowlake.sources.rdbms import identifier
from rowlake.sources.splits import equi_depth


def lake_scan(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    late = F.col("o_orderkey") % 2 == 1
    lake = fx.new_lake(spark)
    lake.append("orders", orders.where(~late), "half", 0)
    lake.append("orders", orders.where(late).drop("o_orderpriority"), "half", 1)
    return lake.scan("orders")


LAKE_SCAN = """
select o_orderkey, o_orderstatus, case when o_orderkey % 2 = 0 then o_orderpriority end as o_orderpriority from orders
"""


def table_exists(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    lake = fx.new_lake(spark)
    by_language = documents.select("doc_id", F.concat(F.lit("/docs/"), "lang", F.lit(".json")).alias("filename"))
    write_split_by_filename(by_language, lake)
    requested = documents.select(F.explode(F.array("lang", "source")).alias("table_name")).distinct()
    return lake.exists(requested)


TABLE_EXISTS = """
select distinct lang as table_name, true as exists from documents
union select distinct source, false from documents where source not in (select lang from documents)
"""


def lake_append(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    lake = fx.new_lake(spark)
    cheap = F.col("o_totalprice") < 100000
    lake.append("orders", orders.where(cheap), "a", 0, partition_by=["o_orderstatus", "absent"])
    # A later frame may spell its types otherwise; the declared ones win.
    lake.append("orders", orders.where(~cheap).withColumn("o_totalprice", F.col("o_totalprice").cast("string")), "a", 1)
    return lake.scan("orders")


LAKE_APPEND = "select o_orderkey, o_orderstatus, o_totalprice::decimal(18,2) as o_totalprice from orders"


def split_by_filename(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    flat = events.select(
        "event_id", "user_id", F.concat(F.lit("/in/"), "event_type", F.lit(".csv")).alias("filename"),
        F.lit("csv").alias("data_format"),
    )
    lake = fx.new_lake(spark)
    written = write_split_by_filename(flat, lake)
    frames = [lake.scan(w.table_name).withColumn("table_name", F.lit(w.table_name)) for w in written]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


SPLIT_BY_FILENAME = "select event_id, user_id, event_type as table_name from events"


def fan_out_tables(spark, sf_dir):
    lake = fx.new_lake(spark)
    fan_out(routed(fx.sales_messages(spark, sf_dir)), lake, "sales", 0, staging="table")
    return fx.sales_content(lake.scan)


def rows_written(spark, sf_dir):
    lake = fx.new_lake(spark)
    return written_frame(spark, fan_out(routed(fx.sales_messages(spark, sf_dir)), lake, "sales", 0))


ROWS_WRITTEN = """
select 'orders' as table_name, count(*) as rows, 0::bigint as lost_values, false as skipped from orders
union all select 'customer', count(*), 0, false from customer
union all select 'line_item', count(*), 0, false from lineitem
"""


def parquet_append(spark, sf_dir):
    folder = workspace.new_folder(spark, "parquet")
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    small = F.col("p_size") < 25
    write_parquet(part.where(small), folder, partition_by="p_brand")
    write_parquet(part.where(~small), folder, partition_by="p_brand")
    return spark.read.parquet(folder)


def parquet_overwrite(spark, sf_dir):
    folder = workspace.new_folder(spark, "parquet")
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    store_parquet(folder, part)
    store_parquet(folder, part.withColumn("p_size", F.col("p_size") + 1))
    return spark.read.parquet(folder)


def append_twice(spark, sf_dir):
    """Plain appends, without names for their batches: a frame, frames split by file, and after a rewrite."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    lake = fx.new_lake(spark)
    sized = lambda low: part.where(F.col("p_size") % 5 == low)
    lake.append("part", sized(0))
    write_frame(sized(1), lake, table_name="part")
    for low in (2, 3):
        write_split_by_filename(sized(low).withColumn("filename", F.lit("/in/part.csv")), lake)
    lake.rewrite("part", {"p_partkey": F.col("p_partkey"), "p_size": F.col("p_size").cast("bigint")})
    lake.append("part", sized(4))
    return lake.scan("part")


def late_batch(spark, sf_dir):
    """Batches that come in any order around a rewrite: written ones are not added again, late ones are added."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    lake = fx.new_lake(spark)
    append = lambda i: lake.append("part", part.where(F.col("p_partkey") % 5 == i), "sales", i)
    append(1), append(4)
    lake.rewrite("part", {"p_partkey": F.col("p_partkey"), "p_size": F.col("p_size").cast("bigint")})
    skipped = [append(i).skipped for i in (0, 1, 3, 4, 2)]
    return lake.scan("part").withColumn("skipped", F.lit(",".join(map(str, skipped))))


def compact_batches(spark, sf_dir):
    """Many small batches packed into one, a merged one run again, a late and a new one added, and packed once more."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lake = fx.new_lake(spark)
    append = lambda i: lake.append("orders", orders.where(F.col("o_orderkey") % 15 == i), "sales", i)
    for i in (*range(6), *range(7, 13)):
        append(i)
    into = len(lake.compact("orders")[0])
    skipped = [append(i).skipped for i in (3, 6, 13, 14)]
    lake.vacuum("orders")
    lake.compact("orders")
    batches = len(lake._batches("orders", lake.state("orders")))
    note = f"{into} {batches} {' '.join(map(str, skipped))}"
    return lake.scan("orders").withColumn("note", F.lit(note))


def split_scan(spark, sf_dir):
    """Orders read part by part, cut along a column of which one value holds half of all rows and a tenth are null."""
    key = F.col("o_orderkey")
    skewed = F.when(key % 10 == 0, None).when(key % 2 == 0, 7).otherwise(F.col("o_custkey"))
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", skewed.cast("bigint").alias("cut"))
    predicates = equi_depth(orders, ["cut", "o_orderkey"], 16, identifier)
    part = F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(predicates)])
    met = sum((F.when(F.coalesce(F.expr(p), F.lit(False)), 1).otherwise(0) for p in predicates), F.lit(0))
    placed = orders.select("o_orderkey", part.alias("part"), met.alias("met"))
    sizes = placed.groupBy("part").count().agg(F.max("count").alias("most"), F.avg("count").alias("mean"))
    even = sizes.select((F.col("most") <= 2 * F.col("mean")).alias("even"))
    return placed.select("o_orderkey", "met", F.lit(even.first()["even"]).alias("even"))


def write_path(spark, sf_dir):
    """Where a frame goes by a name, by a directory, and by both."""
    nation = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lake = fx.new_lake(spark)
    write_frame(nation, lake, table_name="public.Nation-List")
    write_frame(nation, lake, base=f"{lake.root}/Nation_List")
    write_frame(nation, lake, base=f"{lake.root}/nation_list", table_name="nation_list")
    return lake.scan("nation_list").withColumn("tables", F.lit(",".join(lake.table_names())))


WRITE_PATH = """
select n_nationkey, n_name, 'nation_list' as tables from nation, (values (1), (2), (3)) v(i)
"""

QUERIES = {
    "compact_batches": (
        compact_batches, "select o_orderkey, o_orderstatus, o_totalprice, '12 1 True False False False' as note from orders",
    ),
    "split_scan": (split_scan, "select o_orderkey, 1 as met, true as even from orders"),
    "late_batch": (
        late_batch, "select p_partkey, p_size::bigint as p_size, 'False,True,False,True,False' as skipped from part",
    ),
    "append_twice": (append_twice, "select p_partkey, p_size::bigint as p_size from part"),
    "write_path": (write_path, WRITE_PATH),
    "lake_scan": (lake_scan, LAKE_SCAN),
    "table_exists": (table_exists, TABLE_EXISTS),
    "lake_append": (lake_append, LAKE_APPEND),
    "split_by_filename": (split_by_filename, SPLIT_BY_FILENAME),
    "fan_out": (fan_out_tables, fx.sales_sql()),
    "rows_written": (rows_written, ROWS_WRITTEN),
    "parquet_append": (parquet_append, "select p_partkey, p_brand, p_size from part"),
    "parquet_overwrite": (parquet_overwrite, "select p_partkey, p_brand, p_size + 1 as p_size from part"),
}
