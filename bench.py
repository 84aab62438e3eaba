"""Time the headline operators on one message log and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores; ``BENCH_TABLES``
is the number of tables of the last drain (500), beside one into five. Building
the log is set-up and is not timed. Figures are the best of three runs, but for
schema changes and the drain into many tables, which happen once.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession, functions as F

from rowlake.operators import profile, shape
from rowlake.operators.evolve import apply_operations
from rowlake.plans.bulk import OFFSET_SCHEMA, bulk_ingest, log_backlog
from rowlake.queries import fixtures as fx
from rowlake.queries.evolution import operations, requests
from rowlake.queries.shaping import routed
from rowlake.queries.typing import typed_events
from rowlake.sources.envelope import decode_envelope
from rowlake.sources.messages import replay_batch, replay_stream
from rowlake.streaming.ingest import stream_ingest
from rowlake import workspace


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    path = fx.written_log(spark, fx.sales_messages(spark, sf_dir).repartition(3 * int(cpus)))
    log = replay_batch(spark, path)
    message_count = log.count()

    def sink(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def ingest(**options):
        lake = fx.new_lake(spark)
        bulk_ingest(log, lake, "bench", **options)
        return lake

    def stream() -> None:
        lake = fx.new_lake(spark)
        source = replay_stream(spark, path, max_files_per_trigger=int(cpus))
        stream_ingest(source, lake, workspace.new_folder(spark, "checkpoint"), drain=True).awaitTermination()

    most = int(os.environ.get("BENCH_TABLES", 500))
    key = F.col("c_custkey")

    def ingest_into(tables: int):
        file = F.concat(F.lit("/in/t"), key % tables, F.lit(".csv"))
        value = fx.envelope(file, fx.sent_at(key), F.array(fx.row_of(fx.CUSTOMER)))
        rows = fx.table(spark, sf_dir, "customer")
        bulk_ingest(
            rows.select((key % 4).cast("int").alias("partition"), key.alias("offset"), value.alias("value")),
            fx.new_lake(spark), "bench", staging="cache",
        )

    loaded = ingest()
    nothing = spark.createDataFrame([], OFFSET_SCHEMA)

    def change(kind: str, **params):
        return lambda: apply_operations(requests(spark, (kind, "line_item", params)), ingested[0]).collect()

    ingested = [loaded]
    flat = loaded.scan("line_item")
    jobs = {
        "decode_envelope": lambda: sink(decode_envelope(log)),
        "route_rows": lambda: sink(routed(log)),
        "profile_columns": lambda: profile.profile_columns(routed(log), packed=True).collect(),
        "infer_types": lambda: profile.infer_types(typed_events(spark, sf_dir)).collect(),
        "bulk_ingest": ingest,
        "bulk_ingest_staged": lambda: ingest(staging="table"),
        "stream_ingest": stream,
        "lake_scan": lambda: flat.agg(*[F.count(c) for c in flat.columns]).collect(),
        "detect_dates": lambda: shape.date_columns(flat),
        "topic_backlog": lambda: log_backlog(log, nothing).collect(),
        "apply_operations": lambda: sink(
            apply_operations(operations(spark, sf_dir), _two_tables(spark, sf_dir))
        ),
        "add_column": change("ADD_COLUMN", column_name="l_extra", logical_type="double"),
        "change_type_rewrite": change("CHANGE_TYPE", column_name="l_quantity", to_logical_type="double"),
        "drop_column": change("DROP_COLUMN", column_name="l_extra"),
        "ingest_5_tables": lambda: ingest_into(5),
        f"ingest_{most}_tables": lambda: ingest_into(most),
    }
    once = {f"ingest_{most}_tables", "change_type_rewrite", "add_column", "drop_column"}
    timings = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(1 if name in once else 3):
            started = time.perf_counter()
            job()
            runs.append(time.perf_counter() - started)
        timings[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "messages": message_count,
                "messages_per_sec_bulk": round(message_count / timings["bulk_ingest"], 1),
                "messages_per_sec_stream": round(message_count / timings["stream_ingest"], 1),
            }
        )
    )
    spark.stop()


def _two_tables(spark, sf_dir):
    lake = fx.new_lake(spark)
    lake.append("part", fx.table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    lake.append("customer", fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    return lake


if __name__ == "__main__":
    main()
