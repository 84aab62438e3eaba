"""Message logs with the columns ``partition``, ``offset``, ``value``."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MESSAGE_SCHEMA = "partition int, offset bigint, value string"

# Messages taken per stream trigger and per drain step.
MAX_OFFSETS_PER_TRIGGER = 5000
DRAIN_STEP = 500


def kafka_stream(
    spark: SparkSession,
    topic: str,
    servers: str,
    starting_offsets: str = "earliest",
    group: str | None = None,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """The topic as a stream. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .option("failOnDataLoss", "false")
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select("partition", "offset", F.col("value").cast("string").alias("value"))


def kafka_batch(
    spark: SparkSession, topic: str, servers: str, ranges: Mapping[int, tuple[int, int]] | None = None
) -> DataFrame:
    """S2 on a broker: the buffered messages, or those inside known offset ranges."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
    if ranges is None:
        reader = reader.option("subscribe", topic)
    else:
        starts, ends = ({topic: {str(p): r[i] for p, r in ranges.items()}} for i in (0, 1))
        reader = (
            reader.option("assign", json.dumps({topic: sorted(ranges)}))
            .option("startingOffsets", json.dumps(starts))
            .option("endingOffsets", json.dumps(ends))
        )
    return reader.load().select("partition", "offset", F.col("value").cast("string").alias("value"))


def replay_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S3: a Parquet message log as a stream, with the columns of S1."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def replay_batch(spark: SparkSession, path: str) -> DataFrame:
    """S3: the same log as a bounded DataFrame."""
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def offset_bounds(messages: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """(partition, start, end_offset) of what is not consumed yet; ``start`` inclusive.

    One aggregate over a log. A source that knows its ends, as a broker does,
    gives them to :func:`open_bounds` instead.
    """
    bounds = messages.groupBy("partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )
    return open_bounds(bounds, committed)


def open_bounds(bounds: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """(partition, first_offset, end_offset) of a source, from the committed offsets on."""
    if committed is None:
        return bounds.select("partition", F.col("first_offset").alias("start"), "end_offset")
    return bounds.join(committed, "partition", "left").select(
        "partition",
        F.greatest("first_offset", F.coalesce("committed", F.lit(0))).alias("start"),
        "end_offset",
    )


def shares(buffered: Mapping[int, int], most: int) -> dict[int, int]:
    """How many messages each partition gives to a drain of ``most``: as even as their numbers allow."""
    out: dict[int, int] = {}
    left, open_ = most, len(buffered)
    for partition, n in sorted(buffered.items(), key=lambda item: (item[1], item[0])):
        out[partition] = min(n, -(-left // open_))
        left, open_ = left - out[partition], open_ - 1
    return out


def drain_ranges(
    bounds: DataFrame, max_messages: int | None = None, messages: DataFrame | None = None
) -> dict[int, tuple[int, int]]:
    """The offset range to read from each partition, at most ``max_messages`` in all.

    One row per partition of the topic reaches the driver, as in any Kafka
    client. The cap counts messages, not offsets, and is shared by the
    partitions, so a step reads from all of them; for that the log itself is
    asked where the last message of each share is. Without the log, as on a
    broker, offsets stand for messages.
    """
    ranges = {r["partition"]: (r["start"], r["end_offset"]) for r in bounds.where("end_offset > start").collect()}
    if max_messages is None or not ranges:
        return ranges
    if messages is None:
        buffered = {p: end - start for p, (start, end) in ranges.items()}
        return {p: (ranges[p][0], ranges[p][0] + n) for p, n in shares(buffered, max_messages).items() if n}
    waiting = within_ranges(messages, ranges).select("partition", "offset")
    counts = {r["partition"]: r["count"] for r in waiting.groupBy("partition").count().collect()}
    wanted = {p: n for p, n in shares(counts, max_messages).items() if n}
    # The n-th offset of each partition; Spark keeps no more than the largest share of each before the shuffle.
    place = F.row_number().over(Window.partitionBy("partition").orderBy("offset"))
    ranked = waiting.withColumn("n", place).where(F.col("n") <= max(wanted.values(), default=0))
    share = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair]) if wanted else F.lit(None)
    last = ranked.where(F.col("n") == share[F.col("partition")]).collect() if wanted else []
    return {r["partition"]: (ranges[r["partition"]][0], r["offset"] + 1) for r in last}


def within_ranges(messages: DataFrame, ranges: Mapping[int, tuple[int, int]]) -> DataFrame:
    """Messages inside the offset ranges; partitions of one range share a test, which reaches the scan."""
    alike: dict[tuple[int, int], list[int]] = {}
    for partition, span in ranges.items():
        alike.setdefault(span, []).append(partition)
    keep = F.lit(False)
    for (start, end), partitions in alike.items():
        keep = keep | (F.col("partition").isin(partitions) & (F.col("offset") >= start) & (F.col("offset") < end))
    return messages.where(keep)


def bounded_drain(
    messages: DataFrame, max_messages: int | None = None, committed: DataFrame | None = None
) -> DataFrame:
    """The messages that are buffered now, from the committed offsets on."""
    return within_ranges(messages, drain_ranges(offset_bounds(messages, committed), max_messages, messages))
