"""Schema operations on lake tables.

Requests are classified as one DataFrame job against the catalog: operation
``n`` on a column sees the effect of operation ``n - 1``. What is to be done is
then folded per table into at most one rewrite.

``ops`` has the columns ``seq, correlation_id, plan_id, idempotency_key, layer,
kind, target, params`` (a text map).
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowlake import workspace
from rowlake.functions.errors import evidence_id
from rowlake.functions.labels import rdbms_type, spark_type, type_label
from rowlake.functions.naming import operation_table_name, physical_table_name
from rowlake.sources.lake import Lake

# Statuses of an operation, and the kinds that are carried out.
OK = "OK"
ALREADY_APPLIED = "ALREADY_APPLIED"
TRANSIENT_ERROR = "TRANSIENT_ERROR"
PERMANENT_ERROR = "PERMANENT_ERROR"
ADD, DROP, CHANGE = "ADD_COLUMN", "DROP_COLUMN", "CHANGE_TYPE"

# Error codes of each backend.
CODES = {
    "lake": {
        "table_absent": {ADD: "DELTA_TABLE_NOT_READY", DROP: "DELTA_NOT_FOUND", CHANGE: "DELTA_TABLE_NOT_READY"},
        "column_absent": "DELTA_COLUMN_NOT_READY",
        "failed": {ADD: "DELTA_ALTER_FAILED", DROP: "DELTA_DROP_COLUMN_FAILED", CHANGE: "DELTA_CHANGE_TYPE_FAILED"},
    },
    "rdbms": {
        "table_absent": {ADD: "RDBMS_TABLE_NOT_READY", CHANGE: "RDBMS_TABLE_NOT_READY"},
        "column_absent": "RDBMS_COLUMN_NOT_READY",
        "failed": {ADD: "RDBMS_ADD_COLUMN_FAILED", DROP: "LAKE_DROP_COLUMN_FAILED", CHANGE: "RDBMS_CHANGE_TYPE_FAILED"},
        "transient": {ADD: "RDBMS_ADD_COLUMN_TRANSIENT", CHANGE: "RDBMS_CHANGE_TYPE_TRANSIENT"},
    },
}
READ_FAILED = "DELTA_READ_TRANSIENT"
DEFAULT_SCHEMA = "public"

RESULT_COLUMNS = [
    "seq", "correlation_id", "plan_id", "idempotency_key", "status", "error_code", "error_message",
    "evidence_snapshot_id",
]

# A window task looks back over at most this many operations of one column.
BLOCK = 1_000_000

# Casts that one projection nests; a longer chain goes on in another rewrite.
NESTED_CASTS = 50


def last_before(
    df: DataFrame, keys: list[str], order: str, values: dict[str, Column], block: int | None = BLOCK
) -> DataFrame:
    """Add, per name, the last non-NULL value of its column in earlier rows of the same key.

    ``order`` is a unique non-negative integer. Rows are cut into blocks of the
    order; windows look back inside a block, and what earlier blocks end with
    is carried over from one row per key and block. So a key with most of the
    rows is spread over as many tasks as it has blocks. Without a block size
    one window per key looks back over everything, for frames known to be small.
    """
    names = list(values)
    if block is None:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: F.last(v, ignorenulls=True).over(before) for n, v in values.items()})
    blocked = df.withColumns({f"_v_{n}": v for n, v in values.items()}).withColumn(
        "_block", F.floor(F.col(order) / block)
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = blocked.groupBy(*keys, "_block").agg(
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(f"_e_{n}") for n in names]
    )
    carried = ends.select(
        *keys, "_block", *[F.last(f"_e_{n}", ignorenulls=True).over(across).alias(f"_c_{n}") for n in names]
    )
    looked = blocked.withColumns({f"_i_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in names})
    joined = looked.join(carried, [*keys, "_block"], "left")
    return joined.select(
        *df.columns, *[F.coalesce(f"_i_{n}", f"_c_{n}").alias(n) for n in names]
    )


def _param(*names: str) -> Column:
    """The first of some parameters that is given and not empty."""
    return F.coalesce(*[F.nullif(F.col("params")[name], F.lit("")) for name in names])


def requested_columns(
    ops: DataFrame, backend: str, naming: str = "ingest", default_schema: str = DEFAULT_SCHEMA
) -> DataFrame:
    """Operations with the table, column and type they ask for."""
    is_add, is_change = F.col("kind") == ADD, F.col("kind") == CHANGE
    if backend == "rdbms":
        column = _param("column_name", "attribute")
        label = _param("to_logical_type", "logical_type")
        schema = F.when(F.col("kind") == DROP, F.lit(default_schema)).otherwise(
            F.coalesce(_param("schema_name"), F.lit(default_schema))
        )
        key = F.concat_ws(".", schema, F.col("requested_table"))
    else:
        column = F.when(F.col("kind") == DROP, _param("column_name", "attribute")).otherwise(_param("column_name"))
        label = F.when(is_add, _param("logical_type")).otherwise(_param("to_logical_type", "logical_type"))
        key = (operation_table_name if naming == "operation" else physical_table_name)(F.col("requested_table"))
    new_type = rdbms_type(label) if backend == "rdbms" else spark_type(label)
    needs_label = is_change & label.isNull()
    fold = F.lower if backend == "lake" else (lambda c: c)
    return (
        ops.withColumn("requested_table", F.coalesce(F.nullif("target", F.lit("")), _param("table_name")))
        .withColumns({"column": column, "new_type": new_type, "needs_label": needs_label})
        .withColumn("table_key", F.when(F.col("requested_table").isNotNull(), key))
        .withColumn("column_key", fold(F.btrim("column") if backend == "lake" else F.col("column")))
    )


def _invalid(backend: str) -> Column:
    """The code of a request that is wrong by itself, NULL for a valid one."""
    no_table = F.col("requested_table").isNull()
    no_column = F.col("column").isNull() | F.col("needs_label")
    table_first = F.when(no_table, "MISSING_TARGET").when(no_column, "MISSING_PARAM")
    valid = table_first
    if backend == "lake":
        column_first = F.when(no_column, "MISSING_PARAM").when(no_table, "MISSING_TARGET")
        valid = F.when(F.col("kind") == ADD, column_first).otherwise(table_first)
    return (
        F.when(F.coalesce(F.col("layer"), F.lit("")) != "LAKE", "WRONG_LAYER")
        .when(~F.coalesce(F.col("kind"), F.lit("")).isin(ADD, DROP, CHANGE), "UNSUPPORTED_OPERATION")
        .otherwise(valid)
    )


def _literal(codes: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[F.col("kind")]


def classify_operations(
    ops: DataFrame, catalog: DataFrame, backend: str = "lake", naming: str = "ingest", block: int | None = BLOCK,
    default_schema: str = DEFAULT_SCHEMA,
) -> DataFrame:
    """Status and error code of every operation, and what it would do.

    ``catalog(table_name, ordinal, name, dtype)`` holds the tables as they are
    before the first operation; RDBMS tables are named ``schema.table``. A table
    without columns is one whose schema cannot be read. If one request spells a
    new column in two ways, the spelling of the last ADD counts.
    """
    requested = requested_columns(ops, backend, naming, default_schema).withColumn("invalid", _invalid(backend))
    tables = catalog.groupBy(F.col("table_name").alias("table_key")).agg(
        F.lit(True).alias("table_known"), F.bool_or(F.col("name").isNotNull()).alias("readable")
    )
    fold = F.lower if backend == "lake" else (lambda c: c)
    columns = catalog.where(F.col("name").isNotNull()).select(
        F.col("table_name").alias("table_key"),
        fold(F.col("name")).alias("column_key"),
        F.col("name").alias("first_name"),
        F.col("dtype").alias("first_type"),
    )
    known = requested.join(tables, "table_key", "left").join(columns, ["table_key", "column_key"], "left")

    valid = F.col("invalid").isNull() & F.coalesce(F.col("table_known"), F.lit(False))
    kind = F.when(valid, F.col("kind"))
    keys = ["table_key", "column_key"]

    # Is the column there, and how is it spelled? The last ADD or DROP before decides.
    drops = (kind == DROP) & (F.col("first_name").isNull() | (F.col("first_name") == F.col("column")))
    events = {
        "added": F.when(kind == ADD, F.struct("seq", "column")),
        "dropped_at": F.when(drops, F.col("seq")),
    }
    added_at = F.coalesce(F.col("added.seq"), F.when(F.col("first_name").isNotNull(), -1), F.lit(-2))
    placed = last_before(known, keys, "seq", events, block).withColumns(
        {
            "present": (added_at > F.coalesce("dropped_at", F.lit(-2))),
            "current_name": F.coalesce("added.column", "first_name"),
        }
    )

    # Its type: set by the last ADD that added it or CHANGE that found it.
    sets_type = ((kind == ADD) & ~F.col("present")) | ((kind == CHANGE) & F.col("present"))
    typed = last_before(placed, keys, "seq", {"last_type": F.when(sets_type, F.col("new_type"))}, block).withColumn(
        "current_type", F.when(F.col("present"), F.coalesce("last_type", "first_type"))
    )
    return _verdicts(typed, backend)


def _verdicts(typed: DataFrame, backend: str) -> DataFrame:
    codes = CODES[backend]
    no_table = ~F.coalesce(F.col("table_known"), F.lit(False))
    present = F.col("present")
    same_name = F.coalesce(F.col("current_name") == F.col("column"), F.lit(False))
    is_add, is_drop, is_change = (F.col("kind") == k for k in (ADD, DROP, CHANGE))
    verdict = F.when(F.col("invalid") == "WRONG_LAYER", _pair(ALREADY_APPLIED, F.col("invalid"))).when(
        F.col("invalid").isNotNull(), _pair(PERMANENT_ERROR, F.col("invalid"))
    )
    if backend == "lake":
        same_type = type_label(F.col("current_type")) == type_label(F.col("new_type"))
        verdict = (
            verdict.when(no_table, _pair(TRANSIENT_ERROR, _literal(codes["table_absent"])))
            .when(~F.col("readable") & is_change, _pair(TRANSIENT_ERROR, F.lit(READ_FAILED)))
            .when(~F.col("readable"), _pair(PERMANENT_ERROR, _literal(codes["failed"])))
            .when(is_add & present & same_name, _pair(ALREADY_APPLIED))
            .when(is_add & present, _pair(PERMANENT_ERROR, _literal(codes["failed"])))
            .when(is_drop & ~(present & same_name), _pair(ALREADY_APPLIED))
            .when(is_change & ~present, _pair(TRANSIENT_ERROR, F.lit(codes["column_absent"])))
            .when(is_change & same_type, _pair(ALREADY_APPLIED))
        )
    else:
        verdict = (
            verdict.when(is_drop & (no_table | ~present), _pair(ALREADY_APPLIED))
            .when(no_table, _pair(TRANSIENT_ERROR, _literal(codes["table_absent"])))
            .when(is_add & present, _pair(ALREADY_APPLIED))
            .when(is_change & ~present, _pair(TRANSIENT_ERROR, F.lit(codes["column_absent"])))
        )
    # Requests that are wrong by themselves carry no evidence id, but for type changes in the lake.
    shows_evidence = F.col("invalid").isNull()
    if backend == "lake":
        shows_evidence = shows_evidence | (is_change & F.col("invalid").isin("MISSING_TARGET", "MISSING_PARAM"))
    return (
        typed.withColumn("verdict", verdict.otherwise(_pair(OK)))
        .withColumns({"status": F.col("verdict.status"), "error_code": F.col("verdict.code")})
        .withColumn("error_message", _message())
        .withColumn(
            "evidence_snapshot_id",
            F.when(shows_evidence, evidence_id(F.col("target"), F.col("plan_id"), F.col("idempotency_key"))).otherwise(""),
        )
        .select(
            *RESULT_COLUMNS, "kind", "table_key", "column_key", "column", "new_type", "first_name", "first_type"
        )
    )


def _pair(status: str, code: Column | None = None) -> Column:
    return F.struct(F.lit(status).alias("status"), (F.lit("") if code is None else code).alias("code"))


def _message() -> Column:
    code = F.col("error_code")
    where = F.concat_ws(".", "table_key", "column")
    return (
        F.when(code == "", "")
        .when(code == "WRONG_LAYER", F.concat(F.lit("layer not handled here: "), F.coalesce("layer", F.lit(""))))
        .when(code == "UNSUPPORTED_OPERATION", F.concat(F.lit("kind not supported: "), F.coalesce("kind", F.lit(""))))
        .when(code == "MISSING_TARGET", F.concat(F.lit("target is required for "), F.col("kind")))
        .when(code == "MISSING_PARAM", F.concat(F.lit("a parameter is missing for "), F.col("kind")))
        .otherwise(F.concat_ws(" ", F.lit("cannot apply"), F.col("kind"), F.lit("to"), where))
    )


# -- carrying out ------------------------------------------------------------


@dataclass(frozen=True)
class ColumnChange:
    """What happens to one column of one table."""

    key: str
    first_name: str | None
    name: str | None
    dtype: str | None
    fresh: bool
    casts: tuple[str, ...]


def held(frame: DataFrame) -> DataFrame:
    """The frame as it is now, in the shared folder; ``workspace.release`` removes it after its last use."""
    folder = workspace.new_folder(frame.sparkSession, "operations")
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def column_changes(classified: DataFrame) -> dict[str, list[ColumnChange]]:
    """The operations that do something, folded to one entry per column, by table.

    The driver gets one row per changed column. The casts in between matter
    only for a column that was neither added nor dropped, as a new one is NULL
    in every old row.
    """
    done = classified.where(F.col("status") == OK)
    keys = ["table_key", "column_key"]
    seq, places = F.col("seq"), F.col("kind") != CHANGE
    folded = done.groupBy(*keys).agg(
        F.max_by("kind", F.when(places, seq)).alias("placed_by"),
        F.max_by("column", F.when(F.col("kind") == ADD, seq)).alias("added_name"),
        F.max_by("new_type", seq).alias("last_type"),
        F.first("first_name").alias("first_name"),
        F.transform(
            F.sort_array(F.collect_list(F.when(~places, F.struct("seq", "new_type")))), lambda x: x["new_type"]
        ).alias("types"),
    )
    by_table: dict[str, list[ColumnChange]] = {}
    for row in folded.toLocalIterator():
        key, old = row["column_key"], row["first_name"]
        fresh = row["placed_by"] == ADD
        if row["placed_by"] == DROP:
            change = ColumnChange(key, old, None, None, False, ())
        elif fresh:
            change = ColumnChange(key, old, row["added_name"], row["last_type"], True, ())
        else:
            change = ColumnChange(key, old, old, row["last_type"], False, shortened(row["types"]))
        by_table.setdefault(row["table_key"], []).append(change)
    return by_table


def shortened(types: Iterable[str]) -> tuple[str, ...]:
    """A sequence of casts without what adds nothing: a value that has been through a cycle of types once
    comes out of the same cycle unchanged."""
    out: list[str] = []
    for dtype in types:
        out.append(dtype)
        for size in range(1, len(out) // 2 + 1):
            if out[-size:] == out[-2 * size : -size]:
                del out[-size:]
                break
    return tuple(out)


def apply_to_table(lake: Lake, table: str, changes: list[ColumnChange], purge: bool = False) -> None:
    """The folded changes of one table, with at most one rewrite.

    Adding, dropping and widening an integer only change the declared schema.
    A rewrite is needed for any other type change, for a name whose old values
    are still in the files, and for a partition column; ``purge`` asks for one.
    """
    longest = max((len(c.casts) for c in changes), default=0)
    if longest > NESTED_CASTS:
        first = [replace(c, dtype=c.casts[:NESTED_CASTS][-1], casts=c.casts[:NESTED_CASTS]) for c in changes if c.casts]
        apply_to_table(lake, table, first, purge)
        rest = [replace(c, casts=c.casts[NESTED_CASTS:]) for c in changes if not c.casts or len(c.casts) > NESTED_CASTS]
        return apply_to_table(lake, table, rest, purge)
    state = lake.required(table)
    fields = dict(state.fields)
    columns = {name: F.col("`" + name.replace("`", "``") + "`") for name in fields}
    rewrite = purge
    stale = {name.lower() for name in state.dropped} | {c.first_name.lower() for c in changes if c.first_name}
    for change in changes:
        old = change.first_name
        if change.fresh or change.name is None:
            if old is not None:
                fields.pop(old, None)
                columns.pop(old, None)
                rewrite = rewrite or old in state.partition_by
        if change.name is None:
            continue
        if change.fresh:
            rewrite = rewrite or change.name.lower() in stale
            fields[change.name] = change.dtype
            columns[change.name] = F.lit(None).cast(change.dtype)
        else:
            before = fields[old]
            value = columns[old]
            for dtype in change.casts:
                value = value.try_cast(dtype)
            fields[old], columns[old] = change.dtype, value
            rewrite = rewrite or (before, change.casts) != ("int", ("bigint",))
    if rewrite:
        lake.rewrite(table, columns, purge)
    else:
        lake.declare(table, fields)


def apply_operations(
    ops: DataFrame, lake: Lake, naming: str = "ingest", writers: int = 8, purge: bool = False
) -> DataFrame:
    """E8 on the lake: classify, carry out, and report one result per operation."""
    spark = lake.spark
    # Written down, because the catalog it was read from is about to change.
    classified = held(classify_operations(ops, lake.catalog(), "lake", naming))
    by_table = column_changes(classified)

    def carry_out(table: str) -> tuple[str, str] | None:
        try:
            apply_to_table(lake, table, sorted(by_table[table], key=lambda c: c.key), purge)
        except Exception as error:  # reported per operation below
            return table, str(error)
        return None

    with ThreadPoolExecutor(max_workers=writers) as pool:
        failures = [f for f in pool.map(inheritable_thread_target(spark)(carry_out), sorted(by_table)) if f]
    return report(classified, failures, "lake")


def report(classified: DataFrame, failures: list[tuple[str, str]], backend: str) -> DataFrame:
    """Results, with the operations of tables that failed turned into errors."""
    if not failures:
        return classified.select(*RESULT_COLUMNS)
    failed = classified.sparkSession.createDataFrame(failures, "table_key string, failure string")
    hit = F.col("failure").isNotNull() & (F.col("status") == OK)
    return (
        classified.join(failed, "table_key", "left")
        .withColumns(
            {
                "error_code": F.when(hit, _literal(CODES[backend]["failed"])).otherwise(F.col("error_code")),
                "error_message": F.when(hit, F.col("failure")).otherwise(F.col("error_message")),
                "status": F.when(hit, PERMANENT_ERROR).otherwise(F.col("status")),
            }
        )
        .select(*RESULT_COLUMNS)
    )
