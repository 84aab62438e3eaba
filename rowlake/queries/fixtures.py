"""Message logs made from the given tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowlake import workspace
from rowlake.plans.bulk import scan_bytes
from rowlake.sources.lake import Lake
from rowlake.sources.messages import replay_batch

ROWS_PER_MESSAGE = 20
LOG_PARTITIONS = 4

ORDERS_FILE = "C:\\landing\\Orders.csv"
LINEITEM_FILE = "/landing/Line-Item.csv"
CUSTOMER_FILE = "/landing/2024/customer.csv"
PART_FILE = "/landing/public.part.csv"
DOCUMENTS_FILE = "documents.json"
EVENTS_FILE = "events.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def sent_at(group: Column) -> Column:
    """When message ``group`` was sent, with a fraction and an offset."""
    return F.concat(F.lit("2024-05-01T10:"), F.lpad((group % 60).cast("string"), 2, "0"), F.lit(":30.750+02:00"))


# The same instant, cut to seconds, as epoch seconds in SQL.
def sent_at_sql(key: str) -> str:
    return f"(epoch(timestamp '2024-05-01 08:00:30')::bigint + 60 * (({key} // {ROWS_PER_MESSAGE}) % 60))"


# The rows of each table as Spark SQL: a NULL is a key the row does not have.
ORDERS = {
    "o_orderkey": "cast(o_orderkey as string)",
    "o_custkey": "if(o_orderkey % 3 <> 0, cast(o_custkey as string), null)",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "cast(cast(o_totalprice as decimal(18,2)) as string)",
    "o_orderdate": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "o_orderpriority": "if(o_orderkey % 5 = 0, '', o_orderpriority)",
}
# The text of ORDERS after the empty string rule, by column.
ORDERS_SQL = {
    "o_orderkey": "o_orderkey::varchar",
    "o_custkey": "case when o_orderkey % 3 <> 0 then o_custkey::varchar end",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "o_totalprice::decimal(18,2)::varchar",
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d')",
    "o_orderpriority": "case when o_orderkey % 5 <> 0 then o_orderpriority end",
}
LINEITEM = {
    **{name: f"cast({name} as string)" for name in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")},
    **{
        name: f"cast(cast({name} as decimal(18,2)) as string)"
        for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    },
    "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus",
    "l_shipdate": "date_format(l_shipdate, 'yyyy-MM-dd')",
}
CUSTOMER = {
    "c_custkey": "cast(c_custkey as string)",
    "c_name": "c_name",
    "c_nationkey": "if(c_custkey % 4 = 0, '', cast(c_nationkey as string))",
    "c_acctbal": "cast(cast(c_acctbal as decimal(18,2)) as string)",
    "c_mktsegment": "if(c_custkey % 3 <> 0, c_mktsegment, null)",
}
PART = {
    "p_partkey": "cast(p_partkey as string)",
    "p_name": "p_name",
    "p_brand": "if(p_partkey % 3 <> 0, p_brand, null)",
    "p_size": "if(p_partkey % 5 = 0, '', cast(p_size as string))",
    "p_retailprice": "cast(cast(p_retailprice as decimal(18,2)) as string)",
}
DOCUMENTS = {"doc_id": "cast(doc_id as string)", "text": "text", "lang": "lang", "source": "source"}
# Event rows keep their JSON types.
EVENTS = {
    "event_id": "event_id",
    "user_id": "if(event_id % 4 <> 0, user_id, null)",
    "value": "value",
    "event_type": "if(event_id % 6 = 0, '', event_type)",
    "seen": "if(event_id % 8 = 3, 'later', date_format(ts, 'yyyy-MM-dd'))",
    "is_error": "event_type = 'error'",
    "nothing": "''",
    "props": "from_json(props, 'k int')",
}


def row_of(fields: dict[str, str]) -> Column:
    """A row as JSON writes it: keys without a value are left out."""
    return F.struct(*[F.expr(value).alias(name) for name, value in fields.items()])


def envelope(filename: Column, sent: Column, data: Column) -> Column:
    return F.to_json(
        F.struct(
            filename.alias("filename"),
            F.lit("csv").alias("data_format"),
            sent.alias("ingestion_timestamp"),
            data.alias("data"),
        )
    )


def messages(
    df: DataFrame, key: str, filename: str, fields: dict[str, str], first_partition: int = 0, drop_row: str | None = None
) -> DataFrame:
    """Messages of twenty rows each from a table with a dense unique key, in key order.

    Rows for which ``drop_row`` holds become NULL list elements.
    """
    row = row_of(fields)
    if drop_row is not None:
        row = F.when(~F.expr(drop_row), row)
    group = F.floor(F.col(key) / ROWS_PER_MESSAGE)
    grouped = (
        # Moved as plain columns; collecting before that sorts, and spills, all that a task reads.
        df.withColumn("grp", group).repartition("grp").select("grp", F.col(key).alias("k"), row.alias("r"))
        .groupBy("grp")
        .agg(F.sort_array(F.collect_list(F.struct("k", "r"))).alias("entries"))
    )
    data = F.transform("entries", lambda e: e["r"])
    return grouped.select(
        (first_partition + F.col("grp") % LOG_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("grp") / LOG_PARTITIONS).alias("offset"),
        envelope(F.lit(filename), sent_at(F.col("grp")), data).alias("value"),
    )


def _in_twenties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``p, grp, data``: each twenty rows of a partition as a list, the last ones as they are."""
    number, held = 0, []

    def listed(rows: pa.Table, end: int) -> pa.RecordBatch:
        starts = range(0, end, ROWS_PER_MESSAGE)
        data = pa.ListArray.from_arrays(pa.array([*starts, end], pa.int32()), pa.concat_arrays(rows["r"].chunks).slice(0, end))
        own = [rows["p"][0].as_py()] * len(starts)
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(range(number, number + len(starts)), pa.int64()), data], ["p", "grp", "data"]
        )

    for batch in batches:
        rows = pa.Table.from_batches([*held, batch])
        end = rows.num_rows - rows.num_rows % ROWS_PER_MESSAGE
        if end:
            yield listed(rows, end)
            number += end // ROWS_PER_MESSAGE
        held = rows.slice(end).to_batches()
    if held and sum(b.num_rows for b in held):
        rows = pa.Table.from_batches(held)
        yield listed(rows, rows.num_rows)


def lineitem_messages(spark: SparkSession, sf_dir: str, first_partition: int = 100) -> DataFrame:
    """Messages of twenty rows each in file order, whatever the keys are; rows stay in the task that reads them."""
    rows = table(spark, sf_dir, "lineitem").select(F.spark_partition_id().alias("p"), row_of(LINEITEM).alias("r"))
    fields = ", ".join(f"{name}: string" for name in LINEITEM)
    grouped = rows.mapInArrow(_in_twenties, f"p int, grp bigint, data array<struct<{fields}>>")
    return grouped.select(
        (first_partition + F.col("p")).cast("int").alias("partition"),
        F.col("grp").alias("offset"),
        envelope(F.lit(LINEITEM_FILE), sent_at(F.col("grp")), F.col("data")).alias("value"),
    )


def single_messages(df: DataFrame, key: str, filename: str, fields: dict[str, str], partitions: int = LOG_PARTITIONS) -> DataFrame:
    """One message per row of a table with a dense unique key; the key deals the partitions."""
    value = envelope(F.lit(filename), sent_at(F.floor(F.col(key) / ROWS_PER_MESSAGE)), F.array(row_of(fields)))
    return df.select(
        (F.col(key) % partitions).cast("int").alias("partition"), F.floor(F.col(key) / partitions).alias("offset"), value.alias("value")
    )


def orders_messages(spark, sf_dir, **options) -> DataFrame:
    return messages(table(spark, sf_dir, "orders"), "o_orderkey", ORDERS_FILE, ORDERS, **options)


def customer_messages(spark, sf_dir, first_partition: int = 10) -> DataFrame:
    return messages(table(spark, sf_dir, "customer"), "c_custkey", CUSTOMER_FILE, CUSTOMER, first_partition)


def part_messages(spark, sf_dir, first_partition: int = 20) -> DataFrame:
    return messages(table(spark, sf_dir, "part"), "p_partkey", PART_FILE, PART, first_partition)


def document_messages(spark, sf_dir) -> DataFrame:
    return messages(table(spark, sf_dir, "documents"), "doc_id", DOCUMENTS_FILE, DOCUMENTS)


def event_messages(spark, sf_dir) -> DataFrame:
    return messages(table(spark, sf_dir, "events"), "event_id", EVENTS_FILE, EVENTS)


def sales_messages(spark, sf_dir) -> DataFrame:
    """Orders, customers and line items in one log; line items are most of it."""
    return (
        orders_messages(spark, sf_dir)
        .unionByName(customer_messages(spark, sf_dir))
        .unionByName(lineitem_messages(spark, sf_dir))
    )


def written_log(spark: SparkSession, log: DataFrame) -> str:
    """The log as files, for sources that are read more than once or as a stream."""
    folder = workspace.new_folder(spark, "log")
    log.write.option("compression", "zstd").parquet(folder)
    return folder


#: Bytes of the tables whose messages one file of a log holds.
BYTES_PER_FILE = 96 << 20


def dealt(spark: SparkSession, sf_dir: str, log: DataFrame, names: tuple[str, ...], at_least: int) -> DataFrame:
    """A log in files of bounded size, however large the tables are, but in so many at least."""
    size = sum(scan_bytes(table(spark, sf_dir, name)) for name in names)
    return log.repartition(max(at_least, -(-size // BYTES_PER_FILE)))


#: Bytes of a row group of a log that is read by offsets; a trigger reads few of them.
SEGMENT_BYTES = 1 << 20


def append_segments(log: DataFrame, folder: str) -> None:
    """More of a log, in the order of offsets and in small row groups, as a topic keeps its segments."""
    ordered = log.repartitionByRange("offset", "partition").sortWithinPartitions("offset", "partition")
    ordered.write.mode("append").option("parquet.block.size", SEGMENT_BYTES).parquet(folder)


def logged(spark: SparkSession, log: DataFrame) -> DataFrame:
    return replay_batch(spark, written_log(spark, log))


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, workspace.new_folder(spark, "lake"))


# What a lake holds after SALES, as (table, key, text): text joins all columns.
SALES_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "line_item": list(LINEITEM),
}
CUSTOMER_SQL = {
    "c_custkey": "c_custkey::varchar",
    "c_name": "c_name",
    "c_nationkey": "case when c_custkey % 4 <> 0 then c_nationkey::varchar end",
    "c_acctbal": "c_acctbal::decimal(18,2)::varchar",
    "c_mktsegment": "case when c_custkey % 3 <> 0 then c_mktsegment end",
}
LINEITEM_SQL = {
    **{name: f"{name}::varchar" for name in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")},
    **{
        name: f"{name}::decimal(18,2)::varchar"
        for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    },
    "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus",
    "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')",
}


def _joined_sql(columns: dict[str, str], order: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({columns[c]}, '~')" for c in order) + ")"


def sales_sql() -> str:
    parts = [("orders", "orders", ORDERS_SQL), ("customer", "customer", CUSTOMER_SQL), ("line_item", "lineitem", LINEITEM_SQL)]
    return " union all ".join(
        f"select '{name}' as table_name, {columns[SALES_COLUMNS[name][0]]} as row_key, "
        f"{_joined_sql(columns, SALES_COLUMNS[name])} as row_text from {source}"
        for name, source, columns in parts
    )


def sales_content(scan) -> DataFrame:
    """Every row of the three tables as (table_name, row_key, row_text)."""
    frames = []
    for name, columns in SALES_COLUMNS.items():
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
        frames.append(
            scan(name).select(
                F.lit(name).alias("table_name"), F.col(columns[0]).alias("row_key"), F.concat_ws("|", *parts).alias("row_text")
            )
        )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def select_sql(columns: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{sql} as {name}" for name, sql in columns.items()) + f" from {source}"
