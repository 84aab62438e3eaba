"""Decoding of message envelopes into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The envelope fields, and the row keys that describe the file.
ENVELOPE_SCHEMA = (
    "filename string, data_format string, ingestion_timestamp string, data array<map<string,string>>"
)
TYPED_ENVELOPE_SCHEMA = (
    "filename string, data_format string, ingestion_timestamp string, data array<map<string,variant>>"
)
FILE_COLUMNS = ("filename", "data_format")
INGESTION_TIMESTAMP = "ingestion_timestamp"

_MALFORMED = "_malformed"


def _decode(messages: DataFrame, schema: str, *keep: str) -> DataFrame:
    parsed = F.from_json(
        "value", f"{schema}, {_MALFORMED} string", {"columnNameOfCorruptRecord": _MALFORMED}
    )
    fields = [F.col(f"msg.{name}").alias(name) for name in ("filename", "data_format", INGESTION_TIMESTAMP, "data")]
    return messages.select("partition", "offset", *keep, parsed.alias("msg")).select(
        "partition", "offset", *keep, *fields, F.col(f"msg.{_MALFORMED}").isNotNull().alias("malformed")
    )


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Envelope fields with text values; what is malformed is NULL and flagged."""
    return _decode(messages, ENVELOPE_SCHEMA)


def decode_messages_typed(messages: DataFrame) -> DataFrame:
    """As D1, with JSON typed values."""
    return _decode(messages, TYPED_ENVELOPE_SCHEMA)


def decode_envelope_typed(messages: DataFrame) -> DataFrame:
    """Envelope fields with JSON typed values; messages without a list are skipped."""
    return decode_messages_typed(messages).where(F.col("data").isNotNull())


# Why a message is a dead letter, and what is kept of it.
MALFORMED, NO_LIST = "malformed", "no list"
LETTER_FIELDS = {
    "log_offset": "bigint", "log_partition": "int", "reason": "string", "value": "string", INGESTION_TIMESTAMP: "timestamp",
}


def decode_with_letters(messages: DataFrame, typed: bool = False, no_list: bool = True) -> DataFrame:
    """D1, D2 with a second output: messages that hold no rows become one row that says which message it was.

    ``letter`` marks them. These are the malformed ones and, with ``no_list``, those whose ``data`` is no
    list. Their row has the message's place, the reason and its text, so they take the way of all rows.
    """
    decoded = _decode(messages, TYPED_ENVELOPE_SCHEMA if typed else ENVELOPE_SCHEMA, "value")
    dead = F.col("malformed") | (F.col("data").isNull() if no_list else F.lit(False))
    kept = {
        "log_partition": F.col("partition").cast("string"), "log_offset": F.col("offset").cast("string"),
        "reason": F.when(F.col("malformed"), MALFORMED).otherwise(NO_LIST), "value": F.col("value"),
    }
    kind = "variant" if typed else "string"
    row = F.create_map(*[x for name, text in kept.items() for x in (F.lit(name), text.cast(kind))])
    return decoded.withColumns({"letter": dead, "data": F.when(dead, F.array(row)).otherwise(F.col("data"))}).drop("value")


def explode_rows(envelopes: DataFrame) -> DataFrame:
    """D3: one row per list element, with its position; an empty list gives a NULL row."""
    kept = [name for name in envelopes.columns if name != "data"]
    return envelopes.select(*kept, F.posexplode_outer("data").alias("pos", "row"))


def accept_row_or_data(batch: DataFrame) -> DataFrame:
    """A batch with ``row`` as it is, a batch with ``data`` exploded."""
    has_row, has_data = "row" in batch.columns, "data" in batch.columns
    if has_row == has_data:
        raise ValueError(f"expected exactly one of 'row' and 'data', got columns {batch.columns}")
    return batch if has_row else explode_rows(batch)


def with_keys(row: Column, values: dict[str, Column], value_type: str = "string") -> Column:
    """``row`` with some keys set, whatever it held for them before."""
    kept = F.map_filter(
        F.coalesce(row, F.create_map().cast(f"map<string,{value_type}>")), lambda key, _: ~key.isin(*values)
    )
    added = F.create_map(*[part for name, value in values.items() for part in (F.lit(name), value)])
    return F.map_concat(kept, added)


def propagate_ingestion_timestamp(rows: DataFrame) -> DataFrame:
    """The envelope's timestamp replaces the row's key of that name."""
    return rows.withColumn("row", with_keys(F.col("row"), {INGESTION_TIMESTAMP: F.col(INGESTION_TIMESTAMP)}))


def stamp_file_metadata(rows: DataFrame) -> DataFrame:
    """The envelope's file name and format replace the row's keys of those names."""
    return rows.withColumn("row", with_keys(F.col("row"), {name: F.col(name) for name in FILE_COLUMNS}))
