"""One routed batch to many tables.

The batch is staged once, profiled for all tables in one job, and written
table by table. Only names, types and counts reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass, field, replace
from itertools import islice
from operator import itemgetter
from typing import Protocol

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowlake import workspace
from rowlake.metrics import observation, taken
from rowlake.functions.built import built_once
from rowlake.functions.naming import logical_table_name, physical_table_name
from rowlake.functions.values import normalize_timestamp
from rowlake.operators.profile import packable, profile_columns, profile_typed
from rowlake.operators.shape import (
    MIN_DATE_SHARE,
    check_columns,
    drop_technical,
    text_columns,
    typed_value,
)
from rowlake.plans.history import keep_profile
from rowlake.sources import files
from rowlake.sources.envelope import FILE_COLUMNS, INGESTION_TIMESTAMP, LETTER_FIELDS
from rowlake.sources.lake import VALUES_PER_FILE, VALUES_PER_SMALL_FILE, Lake, SchemaMismatch, Written, file_count, identity

class Sink(Protocol):
    """Where tables live: a ``Lake``, or an ``RdbmsSink``."""

    spark: SparkSession
    backend: str

    def prepare(self, table: str, inferred: Mapping[str, str], partition_by=()) -> Mapping[str, str]:
        """The declared columns, after creating the table if it is missing and
        refusing columns it does not declare."""

    def write_rows(self, table, rows, columns, metrics, source, batch_id, rows_hint) -> Written:
        """Append ``rows.select(columns)``, observing ``metrics`` on the way."""


# Tables of few rows that a task writes; each is a file of its own, which takes longer than its rows.
TABLES_PER_TASK = 20

# Columns of all tables of a batch up to which the driver takes its profile in one job.
FEW_COLUMNS = 1_000

# Tasks that read a micro-batch up to which one task profiles it: the shuffles between two take longer.
FEW_TASKS = 2

# Shuffle partitions over which one table is spread when a batch is staged.
SALTS = 16

# Tables written one by one up to which each reads the staged batch as it is.
FEW_TABLES = 16

# Bytes of what a batch is read from up to which it is held in the executors' cache.
CACHED_BYTES = 256 << 20

# Bytes of a row group of a staged batch; a reader of one table skips those of others.
STAGED_GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Limits:
    """How much of a batch the driver has in hand at once; no bound of what a batch may hold.

    ``page_tables`` are read of the profile at a time; pages wait until they hold
    ``write_tables``, so that tables of equal columns share writes.
    """

    page_tables: int = 1_000
    writers: int = 8
    write_tables: int = 1_000


@dataclass
class TableProfile:
    """The profile of one table of a batch."""

    rows: int = 0
    columns: dict[str, dict] = field(default_factory=dict)


def staged_rows(rows: DataFrame, how: str) -> tuple[DataFrame, Callable[[], None]]:
    """The batch, evaluated once, and what releases it.

    ``cache`` suits a micro-batch or a drain that fits the executors' memory. ``table`` suits a drain of any size: rows
    are written as they come, neither moved nor sorted. Readers skip blocks that hold
    other tables only; where many tables are written one by one, see :func:`write_page`.
    With ``local`` every task writes a file for each table it meets.
    Written copies outlive lost executors.
    """
    kept = rows.select("partition", "offset", "pos", INGESTION_TIMESTAMP, "row", "table_name")
    if how == "cache":
        cached = kept.persist(StorageLevel.MEMORY_AND_DISK)
        return cached, lambda: cached.unpersist()
    if how not in ("table", "local"):
        raise ValueError(f"unknown staging {how!r}")
    return as_it_comes(kept) if how == "table" else by_table(kept, kept.schema, rebalance=False)


def known_bytes(rows: DataFrame) -> int:
    """The bytes of all that a frame is read from, as Spark knows them without planning it.

    What does not know its size, as a source that admits a bounded share per trigger, counts for nothing.
    """
    leaves = rows._jdf.queryExecution().analyzed().collectLeaves()
    unknown = rows.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < unknown)


def read_by_few(rows: DataFrame) -> bool:
    """Is a frame, as that of a micro-batch, read by so few tasks that one may profile it?"""
    leaves = rows._jdf.queryExecution().analyzed().collectLeaves()
    if leaves.size() != 1 or leaves.apply(0).getClass().getSimpleName() != "LogicalRDD":
        return False
    return leaves.apply(0).rdd().getNumPartitions() <= FEW_TASKS


def rebalanced(rows: DataFrame) -> DataFrame:
    """A salt spreads each table over a few shuffle partitions; Spark splits those still too large and joins small ones."""
    return rows.withColumn("_salt", F.spark_partition_id() % SALTS).hint("rebalance", "table_name", "_salt").drop("_salt")


def as_it_comes(rows: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The rows as a written table, whose number of files does not depend on the number of tables."""
    spark = rows.sparkSession
    folder = workspace.new_folder(spark, "staged")
    rows.write.option("parquet.block.size", STAGED_GROUP_BYTES).option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), lambda: files.delete(spark, folder)


def in_order(rows: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """As above, in the order of tables within each file, so that readers of one pass over the row groups of others."""
    return as_it_comes(rebalanced(rows).sortWithinPartitions("table_name"))


def by_table(rows: DataFrame, schema, rebalance: bool = True) -> tuple[DataFrame, Callable[[], None]]:
    """The rows as a written table, partitioned by ``table_name``."""
    spark = rows.sparkSession
    folder = workspace.new_folder(spark, "staged")
    if rebalance:
        rows = rebalanced(rows)
    rows.write.partitionBy("table_name").parquet(folder)
    return spark.read.schema(schema).parquet(folder), lambda: files.delete(spark, folder)


def profile_pages(
    staged: DataFrame, limits: Limits = Limits(), typed: bool = False, keep: Callable[[DataFrame], object] | None = None,
    cached: bool = False, one_task: bool = False,
) -> Iterator[dict[str, TableProfile]]:
    """The profile of every table of the batch, a page of tables at a time.

    One job makes it, with one row per column; the driver reads it in the
    order of tables and holds a page and one partition of it. ``typed`` rows
    hold typed entries (T1). ``keep`` gets the whole profile before the first page.
    Rows that are ``cached`` may be profiled twice: few columns, as those of a
    micro-batch, are taken in one job, and only if there are more is the profile kept. With
    ``one_task`` that job has one task, and no shuffle.
    """
    excluded = (*FILE_COLUMNS, INGESTION_TIMESTAMP)
    if cached and not typed and not keep:
        seen = observation("profile")
        near = staged.coalesce(1) if one_task else staged
        packed = profile_columns(near.observe(seen, packable().alias("packable")), excluded, packed=True)
        found = packed.limit(FEW_COLUMNS + 1).collect()
        if len(found) <= FEW_COLUMNS:
            if found and not taken(seen)["packable"]:
                found = profile_columns(staged, excluded).collect()
            yield from _pages(sorted(found, key=itemgetter("table_name")), limits)
            return
    if typed:
        profile = profile_typed(staged, excluded).persist()
    else:
        seen = observation("profile")
        profile = profile_columns(staged.observe(seen, packable().alias("packable")), excluded, packed=True).persist()
        if profile.count() and not taken(seen)["packable"]:
            profile.unpersist()
            profile = profile_columns(staged, excluded).persist()
    try:
        if keep:
            keep(profile)
        yield from _pages(profile.orderBy("table_name").toLocalIterator(), limits)
    finally:
        profile.unpersist()


def _pages(entries: Iterable, limits: Limits) -> Iterator[dict[str, TableProfile]]:
    """Pages of the profiles of tables from the rows of a profile in the order of tables."""
    page: dict[str, TableProfile] = {}
    for entry in entries:
        name = entry["table_name"]
        if name not in page and len(page) >= limits.page_tables:
            yield page
            page = {}
        table = page.setdefault(name, TableProfile())
        table.rows += entry["rows"]
        if entry["column_name"] is not None:
            table.columns[entry["column_name"]] = entry.asDict()
    if page:
        yield page


def inferred_types(profile: TableProfile, mode: str) -> dict[str, str]:
    """The column types of a new table, in final order.

    A column is a date if its first value is one; in bulk mode also if nearly
    all of its values are, in typed mode if it is a text column of which that holds.
    """
    types = {}
    via = via_types(profile, mode)
    for name in sorted(profile.columns):
        entry = profile.columns[name]
        share = entry["date_hits"] / entry["non_null"] if entry["non_null"] else 0.0
        by_share = mode != "stream" and name not in via and share >= MIN_DATE_SHARE
        types[name] = "date" if entry["first_is_date"] or by_share else "string"
    types[INGESTION_TIMESTAMP] = "timestamp"
    return types


def via_types(profile: TableProfile, mode: str) -> dict[str, str]:
    """The number and truth columns of typed rows; their text is that of their type.

    One that also holds other values is text, so that no value is lost.
    """
    if mode != "typed":
        return {}
    kept = {name: entry["type"].lower() for name, entry in profile.columns.items() if not entry["mixed"]}
    return {name: kind for name, kind in sorted(kept.items()) if kind in ("boolean", "bigint", "double")}


@built_once
def processing_time() -> Column:
    """The time of this batch, as text.

    Text goes into compiled code by reference. As a timestamp it would be a
    constant in the code, which Spark would compile anew for every table of
    every batch; that took longer than the writes themselves.
    """
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def typed_columns(
    declared: Mapping[str, str], names: list[str], mode: str, via: Mapping[str, str]
) -> tuple[list[Column], Column, list[Column]]:
    """Of a frame with ``stamp`` and the text ``v0``, ``v1`` ... of the names: the declared columns, how many
    values of a row do not fit them, and for each column the value that does not.

    ``via`` names the JSON type of a column's values, whose spelling they get.
    """
    columns, lost, misfits = _typed_columns(tuple(declared.items()), tuple(names), mode, tuple(via.items()))
    return [*columns], lost, [*misfits]


@built_once
def _typed_columns(fields: tuple, names: tuple, mode: str, kinds: tuple) -> tuple[list[Column], Column, list[Column]]:
    declared, via = dict(fields), dict(kinds)
    columns, lost, misfits = [], F.lit(0), []
    position = {name: f"v{i}" for i, name in enumerate(names)}
    for name, dtype in declared.items():
        if name == INGESTION_TIMESTAMP:
            columns.append(F.col("stamp").try_cast(dtype).alias(name))
        elif name not in position:
            columns.append(F.lit(None).cast(dtype).alias(name))
        else:
            value = F.col(position[name])
            spelled = value.try_cast(via[name]).cast("string") if name in via else value
            typed = typed_value(spelled, dtype, name, guard=mode == "stream")
            columns.append(typed.alias(name))
            if dtype != "string" or typed is not value:
                misfit = value.isNotNull() & typed.isNull()
                lost = lost + F.when(misfit, 1).otherwise(0)
                misfits.append(F.when(misfit, F.struct(F.lit(name).alias("column_name"), value.alias("value"))))
    return columns, lost, misfits


@built_once
def stamp_column(mode: str, zone: str | None) -> Column:
    sent = F.col(INGESTION_TIMESTAMP)
    return sent.try_cast("timestamp") if mode == "stream" else normalize_timestamp(sent, zone)


def misfit_error(table: str, found) -> SchemaMismatch:
    return SchemaMismatch(f"table {table!r}: {found['value']!r} does not fit {found['column_name']!r}")


def write_table(
    sink: Sink, table: str, staged: DataFrame, profile: TableProfile, declared: Mapping[str, str], how: "How"
) -> Written:
    """The rows of one table, typed as declared, as one batch of that table.

    ``how.mixed`` says that the staged partitions hold rows of many tables. The rows of
    a small table are then filtered where they are and only those are moved;
    joining partitions would move the whole batch to a few tasks.
    """
    rows = staged.where(F.col("table_name") == table)
    if not how.keep_null_rows:
        rows = rows.where(F.size("row") > 0)
    names = sorted(profile.columns)
    # Text first, under plain names, so that the report below can compare it with its typed form.
    kept = ["stamp", *POSITION] if how.on_type_mismatch == "reject" or getattr(sink, "by_place", False) else ["stamp"]
    text = text_columns(rows.withColumn("stamp", stamp_column(how.mode, how.zone)), names, kept, alias="v{}".format)
    if how.mixed and profile.rows * len(names) < VALUES_PER_FILE:
        parts = file_count(profile.rows, len(names))
        # Of a small batch it is faster to read all that is held for each table than to move the rows of one.
        text = text.coalesce(parts) if how.small else text.repartition(parts)
    columns, lost, misfits = typed_columns(declared, names, how.mode, via_types(profile, how.mode))
    if how.on_type_mismatch == "error" and misfits:
        found = text.select(F.coalesce(*misfits).alias("m")).where("m is not null").select("m.*").first()
        if found:
            raise misfit_error(table, found)
    rows_hint = None if how.mixed else profile.rows
    written = sink.write_rows(table, text, columns, {"lost_values": F.sum(lost)}, how.source, how.batch_id, rows_hint)
    if how.on_type_mismatch == "reject" and written.lost_values:
        write_rejects(sink, table, text, misfits, written.lost_values, how)
    return written


def write_rejects(sink: Sink, table: str, text: DataFrame, misfits: list[Column], lost: int, how: "How") -> None:
    """The text of the values of a table that did not fit, in its table of rejects."""
    entries = text.select(*POSITION, F.explode(F.array(*misfits)).alias("m")).where("m is not null")
    names = rejects_of(table)
    sink.prepare(names, REJECT_FIELDS)
    columns = [F.col(c).cast(t).alias(c) for c, t in zip((*POSITION, "m.column_name", "m.value"), REJECT_FIELDS.values())]
    renamed = [c.alias(n) for c, n in zip(columns, REJECT_FIELDS, strict=True)]
    sink.write_rows(names, entries, renamed, {"lost_values": F.lit(0)}, how.source, how.batch_id, lost)


def of_tables(names: Iterable[str]) -> Column:
    """The rows of some tables. As text where names allow it; a thousand literals made one by one take a second."""
    plain = sorted(name for name in {*names} if re.fullmatch(r"[\w.\- ]+", name))
    other = F.col("table_name").isin(sorted({*names} - {*plain}))
    return F.expr("table_name in ('" + "', '".join(plain) + "')") | other if plain else other


def write_alike(
    sink: Lake, tables: Mapping[str, TableProfile], staged: DataFrame, declared: Mapping[str, str], via: Mapping[str, str], how: "How"
) -> list[Written]:
    """Tables of equal declared columns, all with one write; each gets its own directory of it as its batch.

    Rows are rebalanced on the table, so that small tables share a task and a
    large one is split. Counts come from the footers of what was written. Only if
    a value was lost does a second aggregate say in which tables.
    """
    rows = staged.where(of_tables(tables))
    if not how.keep_null_rows:
        rows = rows.where(F.size("row") > 0)
    names = sorted(name for name in declared if name != INGESTION_TIMESTAMP)
    stamped = rows.withColumn("stamp", stamp_column(how.mode, how.zone))
    text = text_columns(stamped, names, ["table_name", "stamp", *POSITION], alias="v{}".format)
    columns, lost, misfits = typed_columns(declared, names, how.mode, via)
    failed: list[Written] = []
    if how.on_type_mismatch == "error" and misfits:
        found = text.select("table_name", F.coalesce(*misfits).alias("m")).where("m is not null").groupBy("table_name")
        for row in found.agg(F.first("m").alias("m")).collect():
            error = misfit_error(row["table_name"], row["m"])
            failed.append(Written(row["table_name"], 0, error=str(error), cause=error))
    left = [t for t in tables if t not in {w.table_name for w in failed}]
    if not left:
        return failed
    if failed:
        text = text.where(of_tables(left))
    seen = observation("tables")
    out = text.observe(seen, F.sum(lost).alias("lost")).select("table_name", *columns)
    values = sum(profile.rows for profile in tables.values()) * max(1, len(names))
    if values < VALUES_PER_FILE:
        out = out.repartition(math.ceil(len(left) / TABLES_PER_TASK), "table_name")
    elif how.scattered:
        out = out.hint("rebalance", "table_name")
    written = sink.write_tables(left, out, how.source, how.batch_id, how.writers)
    if taken(seen).get("lost"):
        of_table = text.groupBy("table_name").agg(F.sum(lost).alias("lost")).where("lost > 0")
        lost_in = {r["table_name"]: r["lost"] for r in of_table.collect()}
        written = [replace(w, lost_values=lost_in.get(w.table_name, 0)) for w in written]
        if how.on_type_mismatch == "reject":
            for table, n in sorted(lost_in.items()):
                write_rejects(sink, table, text.where(F.col("table_name") == table), misfits, n, how)
    return failed + written


@dataclass(frozen=True)
class How:
    """What is the same for all tables of a fan-out."""

    mode: str
    source: str
    batch_id: int
    keep_null_rows: bool = True
    partition_by: tuple[str, ...] = ()
    zone: str | None = None
    scattered: bool = False
    mixed: bool = False
    on_type_mismatch: str = "cast"
    writers: int = 8
    letters: str | None = None
    small: bool = False


def write_page(sink: Sink, staged: DataFrame, profiles: Mapping[str, TableProfile], how: How) -> list[Written]:
    """The tables of a page: those of equal declared columns together where the sink can, all others one by one.

    If the latter are many, their rows are first put in the order of tables.
    """
    ready: dict[str, Mapping[str, str]] = {}

    def prepare(table: str) -> Written:
        inferred = LETTER_FIELDS if table == how.letters else inferred_types(profiles[table], how.mode)
        check_columns(table, inferred)
        ready[table] = sink.prepare(table, inferred, how.partition_by)
        return Written(table, 0)

    refused = [w for w in for_each_table(sink.spark, profiles, prepare, how.writers) if w.error]
    alike: dict[tuple, list[str]] = {}
    for table in sorted(ready):
        together = hasattr(sink, "write_tables") and not how.partition_by
        key = (*ready[table].items(), *via_types(profiles[table], how.mode).items()) if together else (table,)
        alike.setdefault(key, []).append(table)
    single = [own[0] for own in alike.values() if len(own) == 1]
    rows, release = staged, None
    if how.mixed and len(single) > FEW_TABLES:
        rows, release = in_order(staged.where(of_tables(single)))
    try:
        written = for_each_table(
            sink.spark, single, lambda table: write_table(sink, table, rows, profiles[table], ready[table], how), how.writers
        )
    finally:
        if release:
            release()
    for own in alike.values():
        if len(own) > 1:
            try:
                written += write_alike(
                    sink, {t: profiles[t] for t in own}, staged, ready[own[0]], via_types(profiles[own[0]], how.mode), how
                )
            except Exception as error:  # other groups are still written
                written += [Written(t, 0, error=str(error), cause=error) for t in own]
    return sorted(refused + written, key=lambda w: w.table_name)


# Where a value came from, and the columns of a table's rejects.
POSITION = ("partition", "offset", "pos")
REJECT_FIELDS = {"partition": "int", "offset": "bigint", "pos": "int", "column_name": "string", "value": "string"}


def rejects_of(table: str) -> str:
    """The table that keeps the text of values which did not fit ``table``."""
    return f"{table}_rejects"


class TableErrors(ValueError):
    """Tables of a batch that could not be written; all others were."""

    def __init__(self, failed: list[Written]):
        super().__init__("; ".join(f"table {w.table_name!r}: {w.error}" for w in failed[:20]))
        self.failed = failed


def for_each_table(spark, tables: Iterable[str], write: Callable[[str], Written], writers: int) -> list[Written]:
    """Write the tables from a few threads; a table that fails has its error in its report."""

    def attempt(table: str) -> Written:
        try:
            return write(table)
        except Exception as error:  # one table's error does not keep others from being written
            return Written(table, 0, error=str(error), cause=error)

    names = sorted(tables)
    left, done = deque(names), {}

    def some() -> None:
        with suppress(IndexError):
            while True:
                table = left.popleft()
                done[table] = attempt(table)

    # A thread takes over the properties of this one once, not for each of its tables.
    with ThreadPoolExecutor(max_workers=max(1, writers)) as pool:
        for work in [pool.submit(inheritable_thread_target(spark)(some)) for _ in range(min(max(1, writers), len(names)))]:
            work.result()
    return [done[table] for table in names]


def settled(written: list[Written], on_error: str) -> list[Written]:
    """The reports; failed tables are raised together unless the caller wants them as reports."""
    failed = [w for w in written if w.error]
    if failed and on_error == "raise":
        if len(failed) == 1:
            raise failed[0].cause
        raise TableErrors(failed)
    return written


def fan_out(
    rows: DataFrame,
    sink: Sink,
    source: str,
    batch_id: int,
    mode: str = "stream",
    staging: str = "auto",
    limits: Limits = Limits(),
    keep_null_rows: bool = True,
    partition_by: Iterable[str] = (),
    zone: str | None = None,
    on_type_mismatch: str = "cast",
    on_error: str = "raise",
    history: Lake | None = None,
    letters: str | None = None,
) -> list[Written]:
    """K3: stage, profile, and append every table of a routed batch.

    In stream mode a table without keys in this batch is skipped and a NULL
    row of any other table is a row of NULLs (H8). In bulk mode the ingestion
    timestamp is a key of every row, so no table is without keys. In typed mode,
    for the rows of ``route_typed``, columns have the type of their first value
    (T1), and what is no date is stored as its text (H7).

    A table that fails does not keep others from being written. Afterwards its
    error is raised, or with ``on_error="report"`` left in its report. Values
    that do not fit a declared type are NULL; ``on_type_mismatch="error"``
    fails their table, ``"reject"`` also keeps their text, in the table's
    rejects (see :func:`rejects_of`). With ``history``, a lake, the profile of
    the batch is kept under the batch's name (see :mod:`rowlake.plans.history`).
    ``letters`` names the table of dead letters among the rows, whose columns are fixed.
    All ways of ``staging`` have the same result; ``auto`` takes the cache unless the batch is known to be large.
    """
    if mode == "stream":
        rows = rows.withColumn(INGESTION_TIMESTAMP, processing_time())
    if on_type_mismatch not in ("cast", "error", "reject"):
        raise ValueError(f"unknown on_type_mismatch {on_type_mismatch!r}")
    if staging == "auto":
        staging = "cache" if known_bytes(rows) <= CACHED_BYTES else "table"
    how = How(
        mode, source, batch_id, keep_null_rows, tuple(partition_by), zone, staging == "cache", staging != "local", on_type_mismatch,
        limits.writers, letters,
    )
    staged, release = staged_rows(rows, staging)
    written: list[Written] = []
    try:
        text = staged.withColumn("row", F.transform_values("row", lambda _, v: v["text"])) if mode == "typed" else staged
        keep = history and (lambda profile: keep_profile(history, profile, source, batch_id))
        waiting: dict[str, TableProfile] = {}
        one_task = staging == "cache" and read_by_few(rows)
        for page in profile_pages(staged, limits, mode == "typed", keep, staging == "cache", one_task):
            waiting |= {t: p for t, p in page.items() if p.columns or (mode != "stream" and p.rows)}
            if len(waiting) >= limits.write_tables:
                written += write_page(sink, text, waiting, how)
                waiting = {}
        if waiting:
            values = sum(p.rows * max(1, len(p.columns)) for p in waiting.values())
            few = not written and len(waiting) <= FEW_TABLES and values <= VALUES_PER_SMALL_FILE
            written += write_page(sink, text, waiting, replace(how, small=few))
    finally:
        release()
    return settled(written, on_error)


def write_split_by_filename(
    df: DataFrame, lake: Lake, source: str | None = None, batch_id: int | None = None, limits: Limits = Limits(),
    partition_by=(), on_error: str = "raise",
) -> list[Written]:
    """K2: a flat frame with a ``filename`` column, one append per table.

    Files of one table are appended together, so the number of files does not
    matter, only the number of tables, which are taken a page at a time. A NULL
    file name goes to the default table. Identity is as in ``Lake.append``.
    """
    identity(source, batch_id)
    named = df.withColumn("table_name", physical_table_name(logical_table_name(F.col("filename"))))
    staged, release = by_table(named, named.schema)
    written: list[Written] = []
    try:
        counted = staged.groupBy("table_name").count().orderBy("table_name").toLocalIterator()
        flat = drop_technical(staged, with_filename=True)
        while page := {row["table_name"]: row["count"] for row in islice(counted, limits.page_tables)}:
            written += for_each_table(
                lake.spark,
                page,
                lambda table, of=page: lake.append(
                    table, flat.where(F.col("table_name") == table).drop("table_name"), source, batch_id, partition_by,
                    rows_hint=of[table],
                ),
                limits.writers,
            )
    finally:
        release()
    return settled(written, on_error)


def write_frame(
    df: DataFrame, lake: Lake, base: str | None = None, table_name: str | None = None,
    source: str | None = None, batch_id: int | None = None, partition_by: Iterable[str] = (),
) -> list[Written]:
    """A flat frame to where its file names, a table name or a directory say.

    A ``filename`` column splits the frame into tables; otherwise
    ``Lake.resolve`` finds the one table that is meant.
    """
    if "filename" in df.columns:
        return write_split_by_filename(df, lake, source, batch_id, partition_by=partition_by)
    physical = None
    if table_name:
        physical = lake.spark.range(1).select(physical_table_name(F.lit(table_name))).first()[0]
    table = lake.resolve(physical, base)
    return [lake.append(table, drop_technical(df), source, batch_id, partition_by)]


def written_frame(spark, reports: Iterable[Written]) -> DataFrame:
    """The reports as rows."""
    return spark.createDataFrame(
        [(r.table_name, r.rows, r.lost_values, r.skipped) for r in reports],
        "table_name string, rows bigint, lost_values bigint, skipped boolean",
    )
