"""Lake tables: Parquet directories with a declared schema.

    <root>/<table>/schema.json                     declared schema and generation
    <root>/<table>/g<generation>/batch=<source>-<id>/part-*.parquet

An append makes a batch directory of its own. Given a source and a batch id, it
owns the directory of these and overwrites it, so running such a batch again
replaces its rows. A rewrite writes the next generation completely and then
replaces ``schema.json``, which is what readers follow. There is one writer
per table at a time.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from glob import escape, glob
from pathlib import PurePosixPath

import pyarrow.parquet as pq

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowlake.metrics import observation, taken
from rowlake.operators.shape import check_columns, quoted
from rowlake.sources import files

SCHEMA_FILE = "schema.json"
RESERVED = "_rowlake"
BATCH_NAME = re.compile(r"batch=(.*)-(\d+)")
# Sources of appends without an identity; these are never run again, so a rewrite need not remember them.
ONCE = "once."
# Batches that hold the rows of others; one counts only if ``schema.json`` names it.
PACK = f"{ONCE}pack."
#: Batch directories below half of this are packed together up to it.
PACK_BYTES = 128 << 20

# Fixed value: a small append has one to eight files.
SMALL_APPEND_FILES = 8

# A small append makes a file per this many values, a large one fewer.
VALUES_PER_SMALL_FILE = 100_000
VALUES_PER_FILE = 10_000_000

CATALOG_SCHEMA = (
    "table_name string, ordinal int, name string, dtype string, nullable boolean"
)


class SchemaMismatch(ValueError):
    """A frame that the declared schema of its table does not admit."""


@dataclass(frozen=True)
class TableState:
    """What ``schema.json`` says: columns, generation, dropped names, merged batches.

    ``packs`` are directories that hold merged batches, ``packed`` those whose rows they hold.
    """

    fields: dict[str, str]
    generation: int = 0
    dropped: list[str] = field(default_factory=list)
    merged: dict[str, list[list[int]]] = field(default_factory=dict)
    partition_by: list[str] = field(default_factory=list)
    packs: list[str] = field(default_factory=list)
    packed: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        body = asdict(self)
        body["fields"] = [{"name": n, "type": t, "nullable": True} for n, t in self.fields.items()]
        return json.dumps(body)

    @staticmethod
    def from_json(text: str) -> "TableState":
        body = json.loads(text)
        body.pop("table_name", None)
        body["fields"] = {f["name"]: f["type"] for f in body["fields"]}
        # Older files hold the highest id alone.
        body["merged"] = {s: [[0, ids]] if isinstance(ids, int) else ids for s, ids in body["merged"].items()}
        return TableState(**body)

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, T.DataType.fromDDL(t)) for n, t in self.fields.items()]
        )

    def has(self, source: str, batch_id: int) -> bool:
        """Whether the rows of a batch are in the table under no name of their own any more."""
        return any(low <= batch_id <= high for low, high in self.merged.get(files.safe_segment(source), []))


def with_ids(merged: Mapping[str, list[list[int]]], batches: Iterable[str]) -> dict[str, list[list[int]]]:
    """Batch ids by source, as ranges of consecutive ones, with those of more batch directories."""
    ids: dict[str, list[list[int]]] = {source: [list(r) for r in ranges] for source, ranges in merged.items()}
    for name in batches:
        source, batch_id = BATCH_NAME.fullmatch(name).groups()
        if not source.startswith(ONCE):
            ids.setdefault(source, []).append([int(batch_id)] * 2)
    out: dict[str, list[list[int]]] = {}
    for source, ranges in ids.items():
        joined: list[list[int]] = []
        for low, high in sorted(ranges):
            if joined and low <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        out[source] = joined
    return out


@dataclass(frozen=True)
class Written:
    """The report of one append."""

    table_name: str
    rows: int
    lost_values: int = 0
    skipped: bool = False
    error: str | None = None
    cause: Exception | None = field(default=None, repr=False, compare=False)


def _is_pack(name: str) -> bool:
    return name.startswith(f"batch={PACK}")


def first_fit(sizes: Mapping[str, int], most: int) -> list[list[str]]:
    """Names in bins of at most ``most`` in sum, the largest first."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        for i, (held, own) in enumerate(bins):
            if held + size <= most:
                bins[i] = (held + size, [*own, name])
                break
        else:
            bins.append((size, [name]))
    return [own for _, own in bins]


def identity(source: str | None, batch_id: int | None) -> tuple[str, int]:
    """What names a batch directory: as given, or never used before."""
    if (source is None) != (batch_id is None):
        raise ValueError("a source and a batch id come together or not at all")
    if source is None:
        return f"{ONCE}{uuid.uuid4().hex}", 0
    if source.startswith(ONCE):
        raise ValueError(f"sources do not begin with {ONCE!r}")
    return source, batch_id


def file_count(rows: int, columns: int) -> int:
    """K9: an upper bound for the files of an append, by the number of its values."""
    values = rows * max(1, columns)
    small = min(SMALL_APPEND_FILES, math.ceil(values / VALUES_PER_SMALL_FILE))
    return max(1, small, math.ceil(values / VALUES_PER_FILE))


class Lake:
    """The tables below one root directory."""

    backend = "lake"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- names and state ---------------------------------------------------

    def path(self, table: str) -> str:
        if not table:
            raise ValueError("a table needs a name")
        segment = files.safe_segment(table)
        # The lake keeps its own files below the reserved name.
        return f"{self.root}/{'%5F' + segment[1:] if segment.startswith(RESERVED) else segment}"

    def resolve(self, table: str | None = None, place: str | None = None) -> str:
        """The table that a write is for, from its physical name, a directory, or both.

        Tables are the directories directly below the root. The root with a
        name means the table of that name; without one it holds no rows.
        """
        place, root = PurePosixPath(place or self.root), PurePosixPath(self.root)
        found = table if place == root else place.name.lower() if place.parent == root else None
        if found is None or table not in (None, found):
            raise ValueError(f"no table of the lake at {self.root!r}: {place} with the name {table!r}")
        return found

    def state(self, table: str) -> TableState | None:
        text = files.read_text(self.spark, f"{self.path(table)}/{SCHEMA_FILE}")
        return None if text is None else TableState.from_json(text)

    def store(self, table: str, state: TableState) -> None:
        body = json.loads(state.to_json())
        body["table_name"] = table
        files.replace_text(self.spark, f"{self.path(table)}/{SCHEMA_FILE}", json.dumps(body))

    def required(self, table: str) -> TableState:
        state = self.state(table)
        if state is None:
            raise LookupError(f"no lake table at {self.path(table)}")
        return state

    # -- reading -----------------------------------------------------------

    def _batches(self, table: str, state: TableState) -> list[str]:
        found = files.names(self.spark, f"{self.path(table)}/g{state.generation}")
        return [n for n in found if BATCH_NAME.fullmatch(n) and n not in state.packed and (not _is_pack(n) or n in state.packs)]

    def scan(self, table: str) -> DataFrame:
        """The whole table with its declared schema; absent columns are NULL."""
        state = self.required(table)
        return self._read(table, state, state.schema())

    def _read(self, table: str, state: TableState, schema: T.StructType) -> DataFrame:
        batches = self._batches(table, state)
        if not batches:
            return self.spark.createDataFrame([], schema)
        # All there are by a pattern, unless some of what is there does not count.
        there = files.names(self.spark, f"{self.path(table)}/g{state.generation}")
        all_count = len(batches) == sum(bool(BATCH_NAME.fullmatch(n)) for n in there)
        stored = self._stored(table, state, schema, None if all_count else batches)
        return stored.select(*[quoted(name) for name in schema.names])

    def _stored(self, table: str, state: TableState, schema: T.StructType, batches: list[str] | None) -> DataFrame:
        """The files of some batches, or of all there are."""
        generation = f"{self.path(table)}/g{state.generation}"
        reader = self.spark.read.schema(schema)
        if state.partition_by:
            reader = reader.option("basePath", generation)
        return reader.parquet(*[f"{generation}/{name}" for name in batches or ["batch=*"]])

    def catalog(self) -> DataFrame:
        """One row per declared column of every table, read from the schema files.

        A table whose schema file cannot be read has one row without a column.
        """
        if not self.table_names():
            return self.spark.createDataFrame([], CATALOG_SCHEMA)
        declared = "table_name string, fields array<struct<name string, type string, nullable boolean>>"
        folder = F.url_decode(F.element_at(F.split("_metadata.file_path", "/"), -2))
        return (
            self.spark.read.text(f"{self.root}/*/{SCHEMA_FILE}", wholetext=True)
            .select(F.from_json("value", declared).alias("t"), folder.alias("folder"))
            .select(
                F.coalesce("t.table_name", "folder").alias("table_name"),
                F.posexplode_outer("t.fields").alias("ordinal", "f"),
            )
            .select("table_name", "ordinal", "f.name", F.col("f.type").alias("dtype"), "f.nullable")
        )

    def table_names(self) -> list[str]:
        """The directories below the root that hold a table."""
        return files.holding(self.spark, self.root, SCHEMA_FILE)

    def exists(self, requested: DataFrame) -> DataFrame:
        """``requested(table_name)`` with an ``exists`` flag."""
        known = self.catalog().select("table_name").distinct().withColumn("known", F.lit(True))
        return requested.join(known, "table_name", "left").select(
            *requested.columns, F.coalesce("known", F.lit(False)).alias("exists")
        )

    # -- writing -----------------------------------------------------------

    def ensure(self, table: str, fields: Mapping[str, str], partition_by=()) -> TableState:
        """The state of the table, which is created if it is missing."""
        state = self.state(table)
        if state is None:
            check_columns(table, fields)
            kept = [c for c in partition_by if c in fields]
            if kept and "batch" in (name.lower() for name in fields):
                raise ValueError(f"table {table!r}: a partitioned table cannot have a column 'batch'")
            state = TableState(dict(fields), partition_by=kept)
            self.store(table, state)
        return state

    def check_strict(self, table: str, declared: Mapping[str, str], columns) -> None:
        """A column the table does not declare arrives by ADD_COLUMN only."""
        extra = sorted(set(columns) - set(declared))
        if extra:
            raise SchemaMismatch(f"table {table!r} does not declare {extra}")

    def align(self, table: str, df: DataFrame, declared: Mapping[str, str], on_type_mismatch: str = "cast"):
        """The frame in declared form, and what counts values lost to a cast.

        Missing columns are NULL, extra ones an error. The declared type wins:
        other types are cast, or refused with ``on_type_mismatch="error"``.
        """
        self.check_strict(table, declared, df.columns)
        actual = dict(df.dtypes)
        columns, lost = [], F.lit(0)
        for name, dtype in declared.items():
            if name not in actual:
                columns.append(F.lit(None).cast(dtype).alias(name))
            elif actual[name] == dtype:
                columns.append(quoted(name))
            elif on_type_mismatch == "error":
                raise SchemaMismatch(f"table {table!r}: {name!r} is {dtype}, got {actual[name]}")
            else:
                cast = quoted(name).try_cast(dtype)
                columns.append(cast.alias(name))
                lost = lost + F.count_if(quoted(name).isNotNull() & cast.isNull())
        return columns, lost

    def append(
        self,
        table: str,
        df: DataFrame,
        source: str | None = None,
        batch_id: int | None = None,
        partition_by=(),
        on_type_mismatch: str = "cast",
        rows_hint: int | None = None,
    ) -> Written:
        """K1: append by name under the declared schema; no schema merge.

        Each call adds its rows. With a source and a batch id, which come
        together, a second call with the same two replaces the rows of the first.
        """
        identity(source, batch_id)
        state = self.ensure(table, dict(df.dtypes), partition_by)
        columns, lost = self.align(table, df, state.fields, on_type_mismatch)
        return self.write_batch(
            table, state, df, columns, {"lost_values": lost}, source, batch_id, rows_hint
        )

    def prepare(self, table: str, inferred: Mapping[str, str], partition_by=()) -> Mapping[str, str]:
        """The declared columns of a table that is to take the inferred ones."""
        declared = self.ensure(table, inferred, partition_by).fields
        self.check_strict(table, declared, inferred)
        return declared

    def write_rows(self, table, rows, columns, metrics, source, batch_id, rows_hint) -> Written:
        """One table of a fan-out."""
        return self.write_batch(table, self.required(table), rows, columns, metrics, source, batch_id, rows_hint)

    def write_batch(self, table, state, df, columns, metrics, source, batch_id, rows_hint=None) -> Written:
        """Write ``df.select(columns)`` as one batch directory; count in the same job."""
        source, batch_id = identity(source, batch_id)
        if state.has(source, batch_id):
            return Written(table, 0, skipped=True)
        observed = observation("append")
        out = df.observe(
            observed, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]
        ).select(*columns)
        if rows_hint is not None:
            out = out.coalesce(file_count(rows_hint, len(columns)))
        batch = f"batch={files.safe_segment(source)}-{batch_id}"
        writer = out.write.mode("overwrite")
        if state.partition_by:
            writer = writer.partitionBy(*state.partition_by)
        folder = f"{self.path(table)}/g{state.generation}/{batch}"
        writer.options(**files.plain_options(self.spark, folder)).parquet(folder)
        seen = taken(observed)
        return Written(table, seen.get("rows", 0), seen.get("lost_values") or 0)

    def write_tables(self, tables, rows, source, batch_id, writers: int = 8) -> list[Written]:
        """One batch of many tables by one write of ``rows``, which has ``table_name`` and the columns of them all.

        Spark writes a directory per table; each is then renamed to be the
        table's batch, as Spark's own committers do with files. A batch that
        stops in between is run again as a whole.
        """
        spark = self.spark
        source, batch_id = identity(source, batch_id)
        states = {table: self.required(table) for table in tables}
        open_ = [t for t, state in states.items() if not state.has(source, batch_id)]
        skipped = [Written(t, 0, skipped=True) for t in tables if t not in open_]
        if not open_:
            return skipped
        if skipped:
            rows = rows.where(F.col("table_name").isin(open_))
        # A digest names the directories, whatever characters and length a name has.
        column = "_rowlake_table"
        folder = f"{self.root}/{RESERVED}/tables/{uuid.uuid4().hex}"
        # No one reads the folder before it is whole, so tasks may put their files in place themselves.
        writer = rows.withColumn(column, F.md5("table_name")).drop("table_name").write.partitionBy(column)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.options(**files.plain_options(spark, folder)).parquet(folder)
        counts = self._written_rows(folder, column)

        def take(table: str) -> Written:
            own = hashlib.md5(table.encode()).hexdigest()
            batch = f"{self.path(table)}/g{states[table].generation}/batch={files.safe_segment(source)}-{batch_id}"
            files.delete(spark, batch)
            if own in counts:
                files.rename(spark, f"{folder}/{column}={own}", batch)
            return Written(table, counts.get(own, 0))

        with ThreadPoolExecutor(max_workers=max(1, writers)) as pool:
            written = list(pool.map(take, open_))
        files.delete(spark, folder)
        return skipped + written

    def _written_rows(self, folder: str, column: str) -> dict[str, int]:
        """The rows below each ``column=value`` directory of a folder, from the footers of its files.

        Spark starts a task to list each directory, so on the driver's own disk they are read here.
        """
        if (own := files.local_path(self.spark, folder)) is None:
            counted = self.spark.read.schema(f"{column} string").parquet(folder).groupBy(column).count().collect()
            return {r[column]: r["count"] for r in counted}
        counts: dict[str, int] = {}
        for name in files.names(self.spark, folder):
            key, _, value = name.partition("=")
            if key == column:
                counts[value] = sum(pq.read_metadata(f).num_rows for f in glob(f"{escape(own)}/{name}/part-*"))
        return counts

    # -- schema changes ----------------------------------------------------

    def declare(self, table: str, fields: Mapping[str, str]) -> None:
        """Change the declared schema only; columns left out stay in the files."""
        state = self.required(table)
        check_columns(table, fields)
        gone = [name for name in state.fields if name not in fields]
        self.store(table, replace(state, fields=dict(fields), dropped=sorted({*state.dropped, *gone})))

    def rewrite(self, table: str, columns: Mapping[str, F.Column], purge: bool = False) -> None:
        """Write the next generation as a projection of the table, then switch to it.

        The projection needs no shuffle. Batches merged here are remembered,
        so that running one of them again does not add its rows twice. Older
        generations stay for readers that have begun, until a purge or :meth:`vacuum`.
        """
        state = self.required(table)
        merged = with_ids(state.merged, self._batches(table, state))
        current = self.scan(table)
        out = current.select(*[column.alias(name) for name, column in columns.items()])
        fields = dict(out.dtypes)
        check_columns(table, fields)
        generation = state.generation + 1
        kept = [c for c in state.partition_by if c in fields]
        writer = out.write.mode("overwrite")
        if kept:
            writer = writer.partitionBy(*kept)
        writer.parquet(f"{self.path(table)}/g{generation}/batch={ONCE}rewrite-{generation}")
        state = TableState(fields, generation, [], merged, kept)
        self._verify(table, state)
        self.store(table, state)
        if purge:
            self.vacuum(table)

    def compact(self, table: str, pack_bytes: int = PACK_BYTES) -> list[list[str]]:
        """K9: small batch directories packed into few, without a shuffle; which ones went into each.

        Directories are put together by their bytes, first fit from the largest
        down. Packs are written beside them and count from the moment that
        ``schema.json`` names them, which also remembers the ids of the batches
        in them: one that is run again is in the table already. The small
        directories stay for readers that have begun, until :meth:`vacuum`.
        """
        state = self.required(table)
        generation = f"{self.path(table)}/g{state.generation}"
        sizes = {name: files.size(self.spark, f"{generation}/{name}") for name in self._batches(table, state)}
        bins = [own for own in first_fit({n: s for n, s in sizes.items() if s < pack_bytes / 2}, pack_bytes) if len(own) > 1]
        if not bins:
            return []
        schema, made = state.schema(), []
        for own in bins:
            name = f"batch={PACK}{uuid.uuid4().hex}-0"
            rows = self._stored(table, state, schema, own).select(*[quoted(n) for n in schema.names]).coalesce(1)
            writer = rows.write.partitionBy(*state.partition_by) if state.partition_by else rows.write
            writer.parquet(f"{generation}/{name}")
            made.append(name)
        gone = {name for own in bins for name in own}
        packs = [n for n in state.packs if n not in gone] + made
        merged = with_ids(state.merged, gone)
        self.store(table, replace(state, merged=merged, packs=packs, packed=sorted({*state.packed, *gone})))
        return bins

    def vacuum(self, table: str) -> list[str]:
        """Remove the generations and batch directories that ``schema.json`` has left behind."""
        state = self.required(table)
        kept = f"g{state.generation}"
        gone = [n for n in files.names(self.spark, self.path(table)) if re.fullmatch(r"g\d+", n) and n != kept]
        there = files.names(self.spark, f"{self.path(table)}/{kept}")
        gone += [f"{kept}/{n}" for n in there if n in state.packed or (_is_pack(n) and n not in state.packs)]
        for name in gone:
            files.delete(self.spark, f"{self.path(table)}/{name}")
        if state.packed:
            self.store(table, replace(state, packed=[]))
        return gone

    def _verify(self, table: str, state: TableState) -> None:
        """E5: the files of a generation hold the declared types."""
        if not self._batches(table, state):
            return
        # Values of partition columns are in the names of directories, so only the files are asked.
        stored = dict(self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path(table)}/g{state.generation}").dtypes)
        wrong = {n: t for n, t in state.fields.items() if n not in state.partition_by and stored.get(n) != t}
        if wrong:
            raise RuntimeError(f"rewrite of {table!r} did not produce {wrong}, got {stored}")


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by=None) -> None:
    """K4: a plain Parquet directory. Errors reach the caller."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)


def store_parquet(path: str, df: DataFrame, mode: str = "overwrite", partition_by=None) -> None:
    """K5: as K4, replacing what is there unless told otherwise."""
    write_parquet(df, path, mode, partition_by)
