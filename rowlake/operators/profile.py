"""What a batch holds: columns, first types and date shares.

All of it comes out of one grouped pass over (table, column) with fixed-width
aggregation buffers, so Spark combines on the map side and shuffles one row
per table, column and task. A table or column that holds most of the batch
therefore costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowlake.functions.built import built_once
from rowlake.functions.naming import quoted
from rowlake.functions.values import blank_to_null, is_date_name, looks_like_date
from rowlake.sources.envelope import FILE_COLUMNS

# First types by code; a code is the last digit of the arrival key.
FIRST_TYPES = ("BOOLEAN", "BIGINT", "DOUBLE", "DATE", "STRING")
_DATE, _STRING = FIRST_TYPES.index("DATE"), FIRST_TYPES.index("STRING")


def arrival_key(partition: str = "partition", offset: str = "offset", pos: str = "pos") -> Column:
    """(partition, offset, position) as one ordered number, with a free last digit.

    A decimal has a fixed-width buffer, so ``min`` over it stays a hash
    aggregation, which ``min`` over a struct would not. Digits: 7 for the
    partition, 19 for the offset, 10 for the position, 1 free.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(38,0)")

    def power(exponent: int) -> Column:
        return F.lit("1" + "0" * exponent).cast("decimal(38,0)")

    return number(partition) * power(30) + number(offset) * power(11) + number(pos) * power(1)


# Offsets and positions of up to so many bits fit into one long with a free last bit.
OFFSET_BITS, POSITION_BITS = 43, 19


def packed_arrival_key() -> Column:
    """(offset, position) as one ordered long with a free last bit; see ``packable``.

    Made of shifts, which do not fail on what does not fit.
    """
    offset = F.shiftleft(F.coalesce(F.col("offset"), F.lit(0)).cast("bigint"), POSITION_BITS + 1)
    return offset.bitwiseOR(F.shiftleft(F.coalesce(F.col("pos"), F.lit(0)).cast("bigint"), 1))


def unpacked(partition: Column, first: Column) -> Column:
    """The arrival key of a packed one and its partition."""
    def number(value: Column) -> Column:
        return value.cast("decimal(38,0)")

    offset, pos = F.shiftright(first, POSITION_BITS + 1), F.shiftright(first, 1).bitwiseAND((1 << POSITION_BITS) - 1)
    power = [F.lit("1" + "0" * n).cast("decimal(38,0)") for n in (30, 11, 1)]
    return number(partition) * power[0] + number(offset) * power[1] + number(pos) * power[2]


@built_once
def packable() -> Column:
    """An aggregate: do the offsets and positions of a batch fit into a packed key?"""
    fits = F.coalesce(F.col("offset"), F.lit(0)).between(0, (1 << OFFSET_BITS) - 1) & (
        F.coalesce(F.col("pos"), F.lit(0)) < (1 << POSITION_BITS)
    )
    return F.count_if(~fits) == 0


def _first_code(value: Column, code: Column) -> Column:
    """The code of the first value in arrival order; NULL values do not count."""
    return (F.min(F.when(value.isNotNull(), F.col("arrival") + code)) % 10).cast("int")


def _entries(rows: DataFrame, excluded, arrival: Column) -> DataFrame:
    """One row per map entry; a row without entries gives one with a NULL key."""
    keyed = rows.select("table_name", "partition", arrival.alias("arrival"), "row")
    entries = keyed.select(
        "table_name", "partition", "arrival", F.posexplode_outer("row").alias("entry", "column_name", "value")
    )
    return entries.withColumn("is_row", F.coalesce(F.col("entry"), F.lit(0)) == 0).withColumn(
        "column_name", F.when(~F.col("column_name").isin(*excluded), F.col("column_name"))
    )


@built_once
def _profile_parts(excluded: tuple[str, ...], packed: bool) -> tuple[list[Column], ...]:
    """The projections and aggregates of :func:`profile_columns`, in order."""
    value, is_date = F.col("value"), F.col("is_date")
    counts = [
        F.count_if("is_row").alias("rows"),
        F.count(value).alias("non_null"),
        F.count_if(is_date).alias("date_hits"),
    ]
    arrival = packed_arrival_key() if packed else arrival_key()
    keyed = [*map(F.col, ("table_name", "partition")), arrival.alias("arrival"), F.col("row")]
    entries = [*map(F.col, ("table_name", "partition", "arrival")), F.posexplode_outer("row").alias("entry", "column_name", "value")]
    cleaned = [
        *map(F.col, ("table_name", "partition", "arrival")),
        F.when(~F.col("column_name").isin(*excluded), F.col("column_name")).alias("column_name"),
        (F.coalesce(F.col("entry"), F.lit(0)) == 0).alias("is_row"),
        blank_to_null(value).alias("value"), looks_like_date(value).alias("is_date"),
    ]
    keys = [F.col("table_name"), F.col("column_name")]
    out = [*keys, *map(F.col, ("rows", "non_null", "date_hits")), F.coalesce("date", F.lit(False)).alias("first_is_date"), F.col("first_arrival")]
    if packed:
        # The partition is a key of its own, which a task seldom has two of.
        flagged = F.when(value.isNotNull(), F.col("arrival").bitwiseOR(F.when(is_date, 0).otherwise(1).cast("bigint")))
        of_value = F.when(F.col("first").isNotNull(), F.coalesce("partition", F.lit(0)))
        merged = [
            *[F.sum(name).alias(name) for name in ("rows", "non_null", "date_hits")],
            F.min_by("first", of_value).alias("first"), F.min(of_value).alias("of"),
        ]
        names = [*keys, *map(F.col, ("rows", "non_null", "date_hits"))]
        unpack = [*names, (F.col("first") % 2 == 0).alias("date"), unpacked(F.col("of"), F.col("first")).alias("first_arrival")]
        return keyed, entries, cleaned, [*keys, F.col("partition")], [*counts, F.min(flagged).alias("first")], keys, merged, unpack, out
    code = F.when(is_date, F.lit(_DATE)).otherwise(F.lit(_STRING))
    first = F.min(F.when(value.isNotNull(), F.col("arrival")))
    found = [*counts, (_first_code(value, code) == _DATE).alias("date"), first.cast("decimal(38,0)").alias("first_arrival")]
    return keyed, entries, cleaned, keys, found, [], [], [], out


def profile_columns(rows: DataFrame, excluded=FILE_COLUMNS, packed: bool = False) -> DataFrame:
    """Per table and column: value count, date hits, is the first value a date, and the arrival key of that value.

    The entry with a NULL column keeps tables without columns visible;
    ``rows`` adds up, over the columns of a table, to its number of rows. The
    ``packed`` form is faster and right if ``packable`` holds for the rows.
    """
    keyed, entries, cleaned, keys, found, keys_left, merged, unpack, out = _profile_parts(tuple(excluded), packed)
    profile = rows.select(*keyed).select(*entries).select(*cleaned).groupBy(*keys).agg(*found)
    if packed:
        profile = profile.groupBy(*keys_left).agg(*merged).select(*unpack)
    return profile.select(*out)


def materialized_columns(rows: DataFrame, excluded=FILE_COLUMNS) -> DataFrame:
    """H2: the sorted union of the keys of each table, one row per column."""
    return (
        rows.select("table_name", F.explode(F.map_keys("row")).alias("column_name"))
        .where(~F.col("column_name").isin(*excluded))
        .distinct()
    )


def typed_entry(value: Column) -> Column:
    """Of a JSON value: its text, and the code of its type; NULL for null and for the empty text, which T1 passes over."""
    # The label is read once per value; the text of strings tells dates from others.
    label = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    kind = (
        F.when(label == "VOID", None)
        .when(label == "STRING", F.when(text == "", None).when(looks_like_date(text), _DATE).otherwise(_STRING))
        .when(label == "BOOLEAN", FIRST_TYPES.index("BOOLEAN"))
        .when(label == "BIGINT", FIRST_TYPES.index("BIGINT"))
        .when(label.startswith("DECIMAL") | label.isin("DOUBLE", "FLOAT"), FIRST_TYPES.index("DOUBLE"))
        .otherwise(_STRING)
    )
    return F.struct(text.alias("text"), kind.cast("int").alias("kind"))


def _types(entries: DataFrame, *more: Column) -> DataFrame:
    """T1 by table and column of entries with ``arrival`` and ``kind``, and further aggregates of them."""
    names = F.array(*[F.lit(name) for name in FIRST_TYPES])
    family = F.least(F.col("kind"), F.lit(_DATE))
    first = entries.groupBy("table_name", "column_name").agg(
        F.coalesce(_first_code(F.col("kind"), F.col("kind")), F.lit(_STRING)).alias("first_code"),
        F.min(family).alias("low"), F.max(family).alias("high"), *more,
    )
    return first.withColumns(
        {"type": F.get(names, F.col("first_code")), "mixed": F.coalesce(F.col("low") < F.col("high"), F.lit(False))}
    ).drop("first_code")


def infer_types(rows: DataFrame, excluded=FILE_COLUMNS) -> DataFrame:
    """Per table and column the type of the first value, for JSON typed rows.

    ``mixed`` says that later values belong to another family of types.
    """
    entries = _entries(rows, excluded, arrival_key()).where(F.col("column_name").isNotNull())
    typed = entries.withColumn("entry", typed_entry(F.col("value")))
    return _types(typed.withColumn("kind", F.col("entry.kind"))).select("table_name", "column_name", "type", "mixed")


def profile_typed(rows: DataFrame, excluded=FILE_COLUMNS) -> DataFrame:
    """T1 and T6 of all tables in one grouped pass, for rows whose values are typed entries.

    As :func:`profile_columns`, with the first type and ``mixed``; an entry with
    a NULL column keeps tables without columns visible.
    """
    text = F.col("value.text")
    entries = _entries(rows, excluded, arrival_key()).withColumns({"kind": F.col("value.kind"), "text": blank_to_null(text)})
    profile = _types(
        entries, F.count_if("is_row").alias("rows"), F.count("text").alias("non_null"),
        F.count_if(looks_like_date(F.col("text"))).alias("date_hits"),
        F.min(F.when(F.col("kind").isNotNull(), F.col("arrival"))).cast("decimal(38,0)").alias("first_arrival"),
    )
    return profile.withColumn("first_is_date", F.col("type") == FIRST_TYPES[_DATE])


#: A profile as it is kept; ``type``, ``low`` and ``high`` (the families of types met) are those of typed logs.
PROFILE_SCHEMA = (
    "table_name string, column_name string, rows bigint, non_null bigint, date_hits bigint, first_is_date boolean, "
    "first_arrival decimal(38,0), type string, low int, high int"
)


def as_kept(profile: DataFrame) -> DataFrame:
    """A profile of either kind in the form it is kept in."""
    fields = [f.split() for f in PROFILE_SCHEMA.split(", ")]
    return profile.select(
        *[(F.col(name) if name in profile.columns else F.lit(None)).cast(kind).alias(name) for name, kind in fields]
    )


def merged(profiles: DataFrame, min_conf: float) -> DataFrame:
    """T1 and T6 over the kept profiles of any number of batches, as over one batch that holds them all.

    Counts add up and the first value is that of the smallest arrival key, so
    the order of batches and how often they have been merged do not matter.
    ``verdict`` is the type that the column would have.
    """
    at = F.col("first_arrival")
    both = profiles.groupBy("table_name", "column_name").agg(
        *[F.sum(name).alias(name) for name in ("rows", "non_null", "date_hits")],
        F.coalesce(F.min_by("first_is_date", F.when(at.isNotNull(), at)), F.lit(False)).alias("first_is_date"),
        F.min(at).alias("first_arrival"), F.min_by("type", F.when(at.isNotNull(), at)).alias("type"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    spelled = F.col("type").isin(*FIRST_TYPES[:_DATE]) & (F.col("low") == F.col("high"))
    by_share = F.coalesce(F.expr("date_hits / nullif(non_null, 0)") >= min_conf, F.lit(False)) & ~F.coalesce(spelled, F.lit(False))
    return both.withColumn("verdict", F.when(F.col("first_is_date") | by_share, "date").otherwise("string"))


def date_like_columns(columns: DataFrame) -> DataFrame:
    """T4: the columns whose name means a date."""
    return columns.where(is_date_name(F.col("column_name")))


def date_shares(df: DataFrame, pattern: str, min_conf: float) -> DataFrame:
    """Per text column its values, its date hits and the verdict, in one job."""
    columns = [name for name, dtype in df.dtypes if dtype == "string"]
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column_name string, non_null bigint, hits bigint, is_date boolean"
        )
    counts = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(quoted(name)).alias("non_null"),
                F.count_if(looks_like_date(quoted(name), pattern)).alias("hits"),
            ).alias(f"c{index}")
            for index, name in enumerate(columns)
        ]
    )
    share = F.expr("hits / nullif(non_null, 0)")
    return counts.select(F.inline(F.array(*[f"c{index}" for index in range(len(columns))]))).withColumn(
        "is_date", F.coalesce(share >= min_conf, F.lit(False))
    )
