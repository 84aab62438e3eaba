"""RDBMS tables through a Spark catalog.

Everything is catalog SQL, so executors talk to the database and Spark's JDBC
source owns the connections. ``register_jdbc_catalog`` names a database as a
catalog; any other Spark catalog works as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowlake.functions.errors import error_class
from rowlake.functions.labels import RDBMS_NUMERIC, SPARK_OF_RDBMS, rdbms_ddl_name
from rowlake.functions.naming import physical_table_name
from rowlake.metrics import observation, taken
from rowlake.operators.evolve import (
    CODES,
    DEFAULT_SCHEMA,
    OK,
    PERMANENT_ERROR,
    RESULT_COLUMNS,
    TRANSIENT_ERROR,
    ColumnChange,
    classify_operations,
    column_changes,
    held,
    requested_columns,
)
from rowlake.operators.shape import drop_technical, quoted
from rowlake.sources.lake import CATALOG_SCHEMA, SchemaMismatch, Written
from rowlake.sources.ledger import LEDGER, Ledger
from rowlake.sources.splits import SPLITTABLE, equi_depth

# Fixed value: rows per insert.
APPEND_BATCH = 5000

INSERTION_TIMESTAMP = "insertion_timestamp"

# Conditions under which a catalog says that it cannot alter a table in place.
IN_PLACE_REFUSED = (
    "UNSUPPORTED_FEATURE.TABLE_OPERATION",
    "NOT_SUPPORTED_CHANGE_COLUMN",
)


def register_jdbc_catalog(
    spark: SparkSession, name: str, url: str, driver: str, batch: int = APPEND_BATCH, writers: int = 8, **options: str
) -> "Rdbms":
    """Name a database as a Spark catalog; rows are written by ``writers`` tasks in batches."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    settings = {"url": url, "driver": driver, "batchsize": str(batch), "numPartitions": str(writers), **options}
    for key, value in settings.items():
        spark.conf.set(f"{prefix}.{key}", value)
    return Rdbms(spark, name)


def identifier(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def insertable(df: DataFrame) -> DataFrame:
    """Only column types a table can hold; nested values become JSON text."""
    def column(field: T.StructField):
        value, dtype = quoted(field.name), field.dataType
        if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(value).alias(field.name)
        if isinstance(dtype, (T.ByteType, T.ShortType)):
            return value.cast("int").alias(field.name)
        if isinstance(dtype, T.FloatType):
            return value.cast("double").alias(field.name)
        if isinstance(dtype, T.TimestampType):
            return value.cast("timestamp_ntz").alias(field.name)
        kept = (T.IntegerType, T.LongType, T.DoubleType, T.DecimalType, T.BooleanType, T.DateType, T.StringType)
        return value if isinstance(dtype, kept) else value.cast("string").alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def ddl_types(df: DataFrame, style: str = "spark") -> dict[str, str]:
    """The RDBMS column types of a frame."""
    return {f.name: rdbms_ddl_name(f.dataType.simpleString(), style) for f in df.schema.fields}


def change_type_value(value, rdbms_type: str, mode: str = "strict"):
    """The value under its new type; '' is NULL for numbers.

    ``strict`` fails on a value that does not fit, as the database does,
    whatever the session says about ANSI casts; ``lenient`` makes it NULL.
    """
    source = F.nullif(value.cast("string"), F.lit("")) if rdbms_type in RDBMS_NUMERIC else value
    typed = source.try_cast(SPARK_OF_RDBMS.get(rdbms_type, "string"))
    if mode == "lenient":
        return typed
    refusal = F.concat(F.lit(f"invalid input for type {rdbms_type}: "), source.cast("string"))
    return F.when(source.isNotNull() & typed.isNull(), F.raise_error(refusal)).otherwise(typed)


def sql_name(*parts: str) -> str:
    """A name as the database itself quotes it."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in parts)


def type_change_statement(schema: str, table: str, column: str, rdbms_type: str) -> str:
    """E6 as one statement of the database, which converts in place: text for a client of its own to send."""
    name = sql_name(column)
    value = f"NULLIF({name}::text, '')" if rdbms_type in RDBMS_NUMERIC else name
    return f"ALTER TABLE {sql_name(schema, table)} ALTER COLUMN {name} TYPE {rdbms_type} USING {value}::{rdbms_type}"


def create_statement(schema: str, table: str, frame: DataFrame, style: str = "spark") -> str:
    """K7 as the statement of the database, with the column types of T11 or T12."""
    columns = ", ".join(f"{sql_name(n)} {t}" for n, t in ddl_types(frame, style).items())
    return f"CREATE TABLE IF NOT EXISTS {sql_name(schema, table)} ({columns})"


class Rdbms:
    """The tables of one Spark catalog."""

    def __init__(self, spark: SparkSession, catalog: str, default_schema: str = DEFAULT_SCHEMA, readers: int = 64):
        self.spark = spark
        self.readers = readers
        self.catalog = catalog
        self.default_schema = default_schema

    def name(self, schema: str, table: str) -> str:
        return identifier(self.catalog, schema, table)

    # -- catalog -----------------------------------------------------------

    def exists(self, schema: str, table: str) -> bool:
        """S6 for one table."""
        return self.spark.catalog.tableExists(self.name(schema, table))

    def schema(self, schema: str, table: str) -> T.StructType:
        return self.spark.table(self.name(schema, table)).schema

    def columns(self, tables: Iterable[tuple[str, str]]) -> DataFrame:
        """One row per column of each table that exists, in ordinal order."""
        rows = []
        for schema, table in tables:
            if self.exists(schema, table):
                for ordinal, field in enumerate(self.schema(schema, table).fields):
                    rows.append(
                        (f"{schema}.{table}", ordinal, field.name, field.dataType.simpleString(), field.nullable)
                    )
        return self.spark.createDataFrame(rows, CATALOG_SCHEMA)

    # -- writing -----------------------------------------------------------

    def create(self, schema: str, table: str, frame: DataFrame) -> None:
        """K7: schema and table, if missing, from the columns of a frame."""
        columns = ", ".join(f"{identifier(f.name)} {f.dataType.simpleString()}" for f in frame.schema.fields)
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {identifier(self.catalog, schema)}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(schema, table)} ({columns})")

    def append(self, table: str, df: DataFrame) -> Written:
        """K6: insert by column name, from the executors. Missing columns are NULL, extra ones an error.

        ``table`` is ``schema.table``, or a table of the default schema.
        """
        schema, dot, bare = table.partition(".")
        if not dot:
            schema, bare = self.default_schema, table
        bare = self.spark.range(1).select(physical_table_name(F.lit(bare), "rdbms")).first()[0]
        frame = insertable(drop_technical(df))
        self.create(schema, bare, frame)
        observed = observation("insert")
        self.insert(schema, bare, frame.observe(observed, F.count(F.lit(1)).alias("rows")))
        return Written(f"{schema}.{bare}", taken(observed).get("rows", 0))

    def insert(self, schema: str, table: str, frame: DataFrame) -> None:
        view = f"rowlake_{uuid.uuid4().hex}"
        frame.createOrReplaceTempView(view)
        names = ", ".join(identifier(c) for c in frame.columns)
        try:
            self.spark.sql(f"INSERT INTO {self.name(schema, table)} ({names}) SELECT {names} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def bulk_insert(self, table: str, df: DataFrame, drop_columns: Iterable[str] = ()) -> Written:
        """K8: drop columns, stamp the insertion time, create if missing; an empty frame does nothing."""
        frame = df.drop(*drop_columns)
        if not frame.columns:
            return Written(table, 0)
        if INSERTION_TIMESTAMP not in frame.columns:
            frame = frame.withColumn(INSERTION_TIMESTAMP, F.current_timestamp())
        # The input may be costly or differ between runs, so it is evaluated once.
        held = frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return Written(table, 0) if held.isEmpty() else self.append(table, held)
        finally:
            held.unpersist()

    # -- schema changes ----------------------------------------------------

    def add_column(self, schema: str, table: str, column: str, rdbms_type: str) -> None:
        """E2."""
        dtype = SPARK_OF_RDBMS.get(rdbms_type, "string")
        self.spark.sql(f"ALTER TABLE {self.name(schema, table)} ADD COLUMNS ({identifier(column)} {dtype})")

    def drop_column(self, schema: str, table: str, column: str) -> None:
        """By the database where it can, else through a copy."""
        self.change(schema, table, [ColumnChange(column.lower(), column, None, None, False, ())])

    def change_type(self, schema: str, table: str, column: str, rdbms_type: str, mode: str = "strict") -> None:
        """By the database where it can, else through a copy."""
        self.change(schema, table, [ColumnChange(column.lower(), column, column, rdbms_type, False, (rdbms_type,))], mode)

    def change(self, schema: str, table: str, changes: Iterable[ColumnChange], mode: str = "strict") -> None:
        """The folded changes of one table.

        What the catalog can alter is altered; all the rest is one projection
        and so one copy of the table.
        """
        name, values = self.name(schema, table), {}
        fresh = []
        for change in changes:
            old = change.first_name
            if old is not None and (change.fresh or change.name is None):
                if not self._altered(f"ALTER TABLE {name} DROP COLUMN {identifier(old)}"):
                    values[old] = None
            if change.fresh:
                fresh.append((change.name, change.dtype))
            elif change.name is not None:
                values_now = quoted(old)
                in_place = len(change.casts) == 1 and self._altered(
                    f"ALTER TABLE {name} ALTER COLUMN {identifier(old)} TYPE {SPARK_OF_RDBMS.get(change.dtype, 'string')}"
                )
                if not in_place:
                    for dtype in change.casts:
                        values_now = change_type_value(values_now, dtype, mode)
                    values[old] = values_now
        if values:
            stored = self.read(schema, table)
            columns = [values.get(c, quoted(c)) for c in stored.columns]
            self._replace(schema, table, stored.select(*[v.alias(c) for v, c in zip(columns, stored.columns) if v is not None]))
        for column, rdbms_type in fresh:
            self.add_column(schema, table, column, rdbms_type)

    def read(self, schema: str, table: str) -> DataFrame:
        """The whole table; from a database in parts of equal depth (S5), other catalogs cut their own scans."""
        name = self.name(schema, table)
        prefix = f"spark.sql.catalog.{self.catalog}."
        if not self.spark.conf.get(f"{prefix}url", None):
            return self.spark.table(name)
        fields = self.schema(schema, table).fields
        # Whole numbers first, as keys are; no more than two columns are looked at.
        whole = [f.name for f in fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
        cut_by = [*whole, *(f.name for f in fields if isinstance(f.dataType, SPLITTABLE) and f.name not in whole)][:2]
        predicates = equi_depth(self.spark.table(name).select(*map(quoted, cut_by)), cut_by, self.readers, sql_name) if cut_by else ["1 = 1"]
        settings = {k.removeprefix(prefix): v for k, v in self.spark.conf.getAll.items() if k.startswith(prefix)}
        url = settings.pop("url")
        return self.spark.read.jdbc(url, sql_name(schema, table), predicates=predicates, properties=settings)

    def _altered(self, statement: str) -> bool:
        """Run a change that some catalogs refuse to do in place."""
        try:
            self.spark.sql(statement)
            return True
        except PySparkException as refused:
            if refused.getCondition() in IN_PLACE_REFUSED:
                return False
            raise

    def _replace(self, schema: str, table: str, frame: DataFrame) -> None:
        """Write a copy of a table and let it take the table's name.

        Keys, indexes, defaults, grants and NOT NULL are not copied. If the
        second renaming fails the table has its old name again.
        """
        name = self.name(schema, table)
        copy, old = (f"{table[:20]}_{tag}_{uuid.uuid4().hex[:12]}" for tag in ("new", "old"))
        rows = insertable(frame)
        self.create(schema, copy, rows)
        try:
            self.insert(schema, copy, rows)
        except Exception:
            self.spark.sql(f"DROP TABLE {self.name(schema, copy)}")
            raise
        self.spark.sql(f"ALTER TABLE {name} RENAME TO {identifier(schema, old)}")
        try:
            self.spark.sql(f"ALTER TABLE {self.name(schema, copy)} RENAME TO {identifier(schema, table)}")
        except Exception:
            self.spark.sql(f"ALTER TABLE {self.name(schema, old)} RENAME TO {identifier(schema, table)}")
            raise
        self.spark.sql(f"DROP TABLE {self.name(schema, old)}")

    def apply_operations(self, ops: DataFrame, mode: str = "strict") -> DataFrame:
        """E8 on the RDBMS: classify against the catalog, then carry out the folded changes of each table."""
        keys = requested_columns(ops, "rdbms", default_schema=self.default_schema).select("table_key")
        targets = self.named(keys.where("table_key IS NOT NULL").distinct(), "table_key")
        # Held, because the catalog it was read from is about to change.
        classified = held(
            classify_operations(ops, self.columns(tuple(t.split(".", 1)) for t in targets), "rdbms", default_schema=self.default_schema)
        )
        failures = []
        for key, changes in sorted(column_changes(classified).items()):
            schema, table = key.split(".", 1)
            try:
                self.change(schema, table, sorted(changes, key=lambda c: c.key), mode)
            except Exception as error:  # reported for the operations of the table below
                failures.append((key, str(error)))
        return rdbms_report(classified, failures)

    def named(self, names: DataFrame, column: str) -> Iterator[str]:
        """The names a request asks of the database, read a partition at a time."""
        return (row[column] for row in names.toLocalIterator())


class RdbmsSink:
    """One schema of a catalog as the target of a fan-out.

    A batch that is run again inserts only rows that are not in yet, which the
    ledger table of the schema knows. Without one (``ledger=None``) its rows
    are inserted again.
    """

    backend = "rdbms"

    def __init__(self, db: Rdbms, schema: str | None = None, ledger: str | None = LEDGER):
        self.db = db
        self.spark = db.spark
        self.schema = schema or db.default_schema
        self.ledger = Ledger(db, self.schema, ledger) if ledger else None
        self.by_place = self.ledger is not None

    def prepare(self, table: str, inferred: Mapping[str, str], partition_by=()) -> Mapping[str, str]:
        if self.ledger is not None and table == self.ledger.name:
            raise ValueError(f"the name {table!r} is that of the ledger")
        if not self.db.exists(self.schema, table):
            schema = T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in inferred.items()])
            self.db.create(self.schema, table, insertable(self.spark.createDataFrame([], schema)))
        declared = {f.name: f.dataType.simpleString() for f in self.db.schema(self.schema, table).fields}
        extra = sorted(set(inferred) - set(declared))
        if extra:
            raise SchemaMismatch(f"table {table!r} does not declare {extra}")
        return declared

    def write_rows(self, table, rows, columns, metrics, source, batch_id, rows_hint) -> Written:
        if self.ledger is not None:
            names = rows.select(*columns).columns
            seen = self.ledger.write(table, rows, columns, names, metrics, source, batch_id)
            return Written(table, seen["inserted"], seen.get("lost_values") or 0, skipped=bool(seen["rows"]) and not seen["inserted"])
        observed = observation("insert")
        counted = rows.observe(
            observed, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]
        )
        self.db.insert(self.schema, table, counted.select(*columns))
        seen = taken(observed)
        return Written(table, seen.get("rows", 0), seen.get("lost_values") or 0)


def rdbms_report(classified: DataFrame, failures: list[tuple[int, str]]) -> DataFrame:
    """Results, with failed statements classed as passing or permanent."""
    if not failures:
        return classified.select(*RESULT_COLUMNS)
    failed = classified.sparkSession.createDataFrame(failures, "table_key string, failure string")
    codes = CODES["rdbms"]

    def code(of: dict[str, str]):
        return F.create_map(*[F.lit(x) for pair in of.items() for x in pair])[F.col("kind")]

    hit = F.col("failure").isNotNull() & (F.col("status") == OK)
    passing = (error_class(F.col("failure")) != "permanent") & code(codes["transient"]).isNotNull()
    return (
        classified.join(failed, "table_key", "left")
        .withColumns(
            {
                "error_code": F.when(hit & passing, code(codes["transient"]))
                .when(hit, code(codes["failed"]))
                .otherwise(F.col("error_code")),
                "error_message": F.when(hit, F.col("failure")).otherwise(F.col("error_message")),
                "status": F.when(hit & passing, TRANSIENT_ERROR).when(hit, PERMANENT_ERROR).otherwise(F.col("status")),
            }
        )
        .select(*RESULT_COLUMNS)
    )
