"""Bounded ingestion of a message log."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, functions as F

from rowlake.metrics import observation, taken
from rowlake.operators.shape import route_physical, route_typed
from rowlake.plans.fanout import CACHED_BYTES, Limits, Sink, fan_out
from rowlake.sources import files
from rowlake.sources.envelope import decode_envelope, decode_envelope_typed, decode_messages_typed, decode_with_letters
from rowlake.sources.lake import RESERVED, Lake, Written
from rowlake.sources.messages import drain_ranges, offset_bounds, open_bounds, within_ranges

OFFSET_SCHEMA = "partition int, committed bigint"


@dataclass(frozen=True)
class Drained:
    """What one drain did."""

    tables: list[Written]
    ranges: dict[int, tuple[int, int]]
    messages: int
    malformed: int


@dataclass
class OffsetLog:
    """What is known of one source: drains done, next offsets, and the drain under way.

    A few numbers per partition, kept in one file that is replaced as a whole.
    """

    done: int = 0
    committed: dict[int, int] = field(default_factory=dict)
    planned: dict[int, tuple[int, int]] | None = None
    log_name: str | None = None

    @staticmethod
    def path(lake: Lake, source: str) -> str:
        return f"{lake.root}/{RESERVED}/offsets/{files.safe_segment(source)}.json"

    @staticmethod
    def read(lake: Lake, source: str) -> "OffsetLog":
        text = files.read_text(lake.spark, OffsetLog.path(lake, source))
        if text is None:
            return OffsetLog()
        body = json.loads(text)
        planned = body["planned"]
        return OffsetLog(
            body["done"],
            {int(p): end for p, end in body["committed"].items()},
            None if planned is None else {int(p): tuple(r) for p, r in planned.items()},
            body.get("log_name"),
        )

    def write(self, lake: Lake, source: str) -> None:
        files.replace_text(lake.spark, OffsetLog.path(lake, source), json.dumps(asdict(self)))


def committed_offsets(lake: Lake, source: str) -> DataFrame:
    """The next offset to read from each partition, as the last drain left it."""
    return lake.spark.createDataFrame(list(OffsetLog.read(lake, source).committed.items()), OFFSET_SCHEMA)


def commit_offsets(lake: Lake, source: str) -> None:
    """The planned drain has succeeded; the next one starts at its ends."""
    log = OffsetLog.read(lake, source)
    ends = {partition: end for partition, (_, end) in (log.planned or {}).items()}
    OffsetLog(log.done + 1, {**log.committed, **ends}, log_name=log.log_name).write(lake, source)


def bulk_ingest(
    messages: DataFrame,
    lake: Lake,
    source: str,
    max_messages: int | None = None,
    limits: Limits = Limits(),
    staging: str = "auto",
    ranges: dict[int, tuple[int, int]] | None = None,
    sink: Sink | None = None,
    zone: str | None = None,
    log_name: str | None = None,
    ends: DataFrame | None = None,
    typed: bool = False,
    dead_letters: str | None = None,
    **options,
) -> Drained:
    """Drain what is buffered beyond the committed offsets into the lake tables.

    ``source`` names the log in this lake: its offsets are kept under it. With
    ``log_name`` (a topic, a path) the lake remembers which log that is and
    refuses another under the same source.

    The offset ranges are written down first and committed after all tables
    are written. A drain that failed is run again over the same ranges under
    the same id, and its batches replace themselves. Ranges are found from the
    log unless the caller knows them, or knows the ``ends`` (partition,
    first_offset, end_offset), as a broker does. Tables go to the lake that
    keeps the offsets, or to ``sink``; ``options`` are those of ``fan_out``.
    With ``typed`` the JSON types of values count (T1), as in :func:`typed_ingest`.
    ``dead_letters`` names a table that keeps the place and the text of each
    message without rows, malformed or not a list; it is written in the same pass
    as all others, so a drain that is run again replaces its letters too.
    Both stagings have the same result; ``auto`` takes the cache for small scans.
    """
    sink = sink or lake
    state = OffsetLog.read(lake, source)
    if log_name is not None and state.log_name not in (None, log_name):
        raise ValueError(f"source {source!r} of this lake is the log {state.log_name!r}, not {log_name!r}")
    drain_id = state.done
    if state.planned is None:
        if ranges is None:
            committed = committed_offsets(lake, source)
            bounds = offset_bounds(messages, committed) if ends is None else open_bounds(ends, committed)
            ranges = drain_ranges(bounds, max_messages, messages)
        if not ranges:
            return Drained([], {}, 0, 0)
        state.planned, state.log_name = ranges, log_name or state.log_name
        state.write(lake, source)
    ranges = state.planned
    seen = observation("drain")
    taken_now, route = within_ranges(messages, ranges), route_typed if typed else route_physical
    if dead_letters:
        decoded = decode_with_letters(taken_now, typed)
    else:
        decoded = (decode_messages_typed if typed else decode_envelope)(taken_now)
    envelopes = decoded.observe(
        seen, F.count(F.lit(1)).alias("messages"), F.count_if("malformed").alias("malformed")
    )
    rows = route(envelopes.where("size(data) > 0"), sink.backend, dead_letters)
    if staging == "auto":
        staging = "cache" if scan_bytes(taken_now) <= CACHED_BYTES else "table"
    mode = "typed" if typed else "bulk"
    written = fan_out(
        rows, sink, source, drain_id, mode=mode, staging=staging, limits=limits, zone=zone, letters=dead_letters, **options
    )
    commit_offsets(lake, source)
    counts = taken(seen)
    return Drained(written, ranges, counts.get("messages", 0), counts.get("malformed", 0))


def typed_ingest(
    messages: DataFrame, lake: Lake, source: str, batch_id: int, limits: Limits = Limits(), zone: str | None = None, **options
) -> list[Written]:
    """P2 for logs with JSON types: S2, D2, T1, T2, T7, T6, H7 for all tables of a bounded batch.

    Columns have the type of their first value, text columns of dates become
    dates, and all else is stored as text. The types of all tables come from one
    grouped pass over the staged rows. ``bulk_ingest(typed=True)`` does the same
    from the committed offsets on.
    """
    rows = route_typed(decode_envelope_typed(messages).where(F.size("data") > 0))
    return fan_out(rows, lake, source, batch_id, "typed", **{"staging": "table", "limits": limits, "zone": zone, **options})


def scan_bytes(frame: DataFrame) -> int:
    """Spark's own estimate of what a scan reads; sources that do not know say a very large number."""
    return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def drain_in_steps(messages: DataFrame, lake: Lake, source: str, step: int, **options) -> list[Drained]:
    """P4, first half: drain in steps of at most ``step`` messages until nothing is left.

    The ends are those at the start; they are found once and carried over.
    """
    found = messages.groupBy("partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )
    ends = lake.spark.createDataFrame(found.collect(), found.schema)
    done = []
    while (drained := bulk_ingest(messages, lake, source, step, ends=ends, **options)).ranges:
        done.append(drained)
    return done


def topic_backlog(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not consumed yet; a partition without a commit counts in full."""
    left = F.col("end_offset") - F.coalesce("committed", F.lit(0))
    return ends.join(committed, "partition", "left").agg(F.coalesce(F.sum(left), F.lit(0)).alias("backlog"))


def log_backlog(messages: DataFrame, committed: DataFrame) -> DataFrame:
    """P3 for a message log: its ends are the highest offsets it holds."""
    return topic_backlog(offset_bounds(messages).select("partition", "end_offset"), committed)
