"""Rows to typed table frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rowlake.functions.built import built_once
from rowlake.functions.naming import (
    default_name,
    logical_table_name,
    logical_table_name_posix,
    physical_table_name,
    quoted,
)
from rowlake.functions.values import (
    DATE_FORMAT,
    DATE_PATTERN,
    blank_to_null,
    guarded_date,
    is_date_column,
    normalize_timestamp,
    to_date,
)
from rowlake.operators.profile import date_shares, infer_types, typed_entry
from rowlake.sources.envelope import FILE_COLUMNS, INGESTION_TIMESTAMP, accept_row_or_data

# Columns that never reach a table, and the share of dates that makes a date column.
TECHNICAL_COLUMNS = ("data_format", "source_filename", "source_data_format")
MIN_DATE_SHARE = 0.95

# From this many columns on, a row is read as one JSON struct instead of by a
# linear map lookup per column.
WIDE_TABLE = 64


@built_once
def _named(style: str) -> Column:
    rule = logical_table_name_posix if style == "posix" else logical_table_name
    return default_name(rule(F.col("filename")))


def name_table(batch: DataFrame, style: str = "windows") -> DataFrame:
    """The logical table of each envelope or row, from its file name."""
    return batch.withColumn("table_name", _named(style))


def fill_rows(rows: DataFrame) -> DataFrame:
    """A NULL row is an empty one."""
    return rows.withColumn("row", _filled())


@built_once
def _filled() -> Column:
    return F.coalesce("row", F.from_json(F.lit("{}"), "map<string,string>"))


def route_by_table(batch: DataFrame, style: str = "windows") -> DataFrame:
    """H1: rows with their logical table. Envelopes are named before they are exploded."""
    return fill_rows(accept_row_or_data(name_table(batch, style)))


@built_once
def _physical_name(backend: str, letters: str | None) -> Column:
    name = physical_table_name(F.col("table_name"), backend)
    return F.when(F.col("letter"), letters).otherwise(name) if letters else name


def _physical(batch: DataFrame, backend: str, letters: str | None) -> DataFrame:
    return name_table(batch).withColumn("table_name", _physical_name(backend, letters))


def route_physical(batch: DataFrame, backend: str = "lake", letters: str | None = None) -> DataFrame:
    """H1 with the physical name, so that two spellings of a table meet in one; dead letters go to the table of that name."""
    return fill_rows(accept_row_or_data(_physical(batch, backend, letters)))


def route_typed(batch: DataFrame, backend: str = "lake", letters: str | None = None) -> DataFrame:
    """H1 for JSON typed envelopes: each value is a typed entry, its text with the code of its type."""
    rows = accept_row_or_data(_physical(batch, backend, letters))
    entries = F.transform_values("row", lambda _, value: typed_entry(value))
    none = F.from_json(F.lit("{}"), "map<string,struct<text:string,kind:int>>")
    return rows.withColumn("row", F.coalesce(entries, none))


def check_columns(table: str, columns: Iterable[str]) -> None:
    """Two names that differ only by case cannot share a table."""
    seen: dict[str, str] = {}
    for name in columns:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"table {table!r}: the keys {other!r} and {name!r} differ only by case")


@built_once
def _texts(columns: tuple[str, ...], names: tuple[str, ...]) -> list[Column]:
    return [blank_to_null(F.col("row")[c]).alias(n) for c, n in zip(columns, names)]


def text_columns(rows: DataFrame, columns: Iterable[str], keep: Iterable[str] = (), alias=None) -> DataFrame:
    """H3, H4: the text of each column in the given order; missing keys and '' are NULL.

    A wide row is parsed once into a struct; a lookup per column would walk
    the whole map each time.
    """
    columns = list(columns)
    names = [alias(i) if alias else name for i, name in enumerate(columns)]
    if len(columns) < WIDE_TABLE:
        return rows.select(*keep, *_texts(tuple(columns), tuple(names)))
    marked = [("`" + c.replace("`", "``") + "`", "`" + n.replace("`", "``") + "`") for c, n in zip(columns, names)]
    # Spark's column for what it cannot parse must not be one of the row's.
    corrupt = "_corrupt"
    while corrupt in columns:
        corrupt += "_"
    schema = ", ".join(f"{c} string" for c, _ in marked)
    parsed = F.from_json(F.to_json("row"), schema, {"columnNameOfCorruptRecord": corrupt})
    # As text, because a thousand expressions built one by one take seconds.
    return rows.select(*keep, parsed.alias("wide")).selectExpr(
        *keep, *[f"nullif(wide.{c}, '') as {n}" for c, n in marked]
    )


def normalize_rows(rows: DataFrame, columns: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """H3, H4: every row gets every column, in sorted order."""
    return text_columns(rows, sorted(columns), keep)


def typed_value(value: Column, dtype: str, name: str = "", guard: bool = False) -> Column:
    """Text as a column of type ``dtype``; NULL where it does not fit.

    With ``guard``, text columns whose name means a date keep no impossible date (T5).
    """
    if dtype == "string":
        return guarded_date(value) if guard and is_date_column(name) else value
    if dtype == "date":
        return to_date(value)
    return value.try_cast(dtype)


def typed_rows(
    rows: DataFrame, types: Mapping[str, str], keep: Iterable[str] = (), guard: bool = False
) -> DataFrame:
    """Map rows as a frame with the given column types, in sorted order."""
    text = text_columns(rows, sorted(types), keep)
    return text.select(
        *keep, *[typed_value(quoted(name), types[name], name, guard).alias(name) for name in sorted(types)]
    )


def typed_frame(rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """T1, T2, T3 for the JSON typed rows of one table; no rows, no columns.

    A number or truth column that also holds other values is text, so that no
    value is lost.
    """
    found = infer_types(rows).collect()
    if len({r["table_name"] for r in found}) > 1:
        raise ValueError("the rows are of more than one table; each has types of its own")
    types = {
        r["column_name"]: "string" if r["mixed"] and r["type"] != "DATE" else r["type"].lower() for r in found
    }
    text = rows.withColumn(
        "row", F.transform_values("row", lambda _, v: F.try_variant_get(v, "$", "string"))
    )
    return typed_rows(text, types, keep)


def date_columns(df: DataFrame, pattern: str = DATE_PATTERN, min_conf: float = MIN_DATE_SHARE) -> list[str]:
    """The text columns that hold dates; one job for all columns."""
    return [r["column_name"] for r in date_shares(df, pattern, min_conf).where("is_date").collect()]


def detect_dates(
    df: DataFrame, pattern: str = DATE_PATTERN, min_conf: float = MIN_DATE_SHARE, fmt: str = DATE_FORMAT
) -> DataFrame:
    """Text columns that hold dates become date columns."""
    dates = set(date_columns(df, pattern, min_conf))
    return df.select(
        *[to_date(quoted(c), fmt).alias(c) if c in dates else quoted(c) for c in df.columns]
    )


def normalize_ingestion_timestamp(df: DataFrame, zone: str | None = None) -> DataFrame:
    """T7 on the column of that name, if there is one."""
    if INGESTION_TIMESTAMP not in df.columns:
        return df
    return df.withColumn(INGESTION_TIMESTAMP, normalize_timestamp(F.col(INGESTION_TIMESTAMP), zone))


def stamp_ingestion(df: DataFrame, mode: str = "processing") -> DataFrame:
    """Stamp with the processing time, or T7 on the envelope's time."""
    if mode == "envelope":
        return normalize_ingestion_timestamp(df)
    return df.withColumn(INGESTION_TIMESTAMP, F.current_timestamp())


def drop_technical(df: DataFrame, with_filename: bool = False) -> DataFrame:
    """H5: drop what describes the file and not the row."""
    return df.drop(*TECHNICAL_COLUMNS, *(("filename",) if with_filename else ()))


def final_projection(df: DataFrame) -> DataFrame:
    """H6: sorted columns, then the ingestion timestamp."""
    names = sorted(name for name in df.columns if name != INGESTION_TIMESTAMP)
    if INGESTION_TIMESTAMP in df.columns:
        names.append(INGESTION_TIMESTAMP)
    return df.select(*[quoted(name) for name in names])


def stringify(df: DataFrame) -> DataFrame:
    """H7: all but dates, timestamps and the ingestion timestamp as text."""
    return df.select(
        *[
            quoted(name) if dtype in ("date", "timestamp") or name == INGESTION_TIMESTAMP
            else quoted(name).cast("string").alias(name)
            for name, dtype in df.dtypes
        ]
    )


def flat_first_row(batch: DataFrame) -> DataFrame:
    """H9: the keys of the first row as columns, dates detected, time normalised."""
    first = (
        batch.where(F.col("row").isNotNull())
        .orderBy("partition", "offset", "pos")
        .select(F.map_keys("row").alias("keys"))
        .limit(1)
        .collect()
    )
    keys = [k for k in (first[0]["keys"] if first else []) if k not in (*FILE_COLUMNS, INGESTION_TIMESTAMP)]
    flat = batch.select(
        *FILE_COLUMNS, INGESTION_TIMESTAMP, *[F.col("row")[key].alias(key) for key in keys]
    )
    return detect_dates(normalize_ingestion_timestamp(flat))
