"""Type labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Label fragments and the Spark type they stand for, first match
# wins. The RDBMS names beside them are those of the fragment style of T10.
LABEL_FRAGMENTS = [
    (("bool",), "boolean", "BOOLEAN"),
    (("bigint", "long"), "bigint", "BIGINT"),
    (("int",), "int", "INTEGER"),
    (("double", "float", "real"), "double", "DOUBLE PRECISION"),
    (("decimal", "numeric"), "decimal(38,10)", "NUMERIC"),
    (("date",), "date", "DATE"),
    (("timestamp", "datetime", "time"), "timestamp", "TIMESTAMP"),
]

# Exact labels and their RDBMS type; any other label is TEXT.
RDBMS_TYPES = {
    "string": "TEXT",
    "text": "TEXT",
    "integer": "INTEGER",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "DOUBLE PRECISION",
    "double": "DOUBLE PRECISION",
    "boolean": "BOOLEAN",
    "bool": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamptz": "TIMESTAMPTZ",
    "date": "DATE",
}

# RDBMS types whose text values are cast with '' read as NULL.
RDBMS_NUMERIC = ("INTEGER", "BIGINT", "DOUBLE PRECISION", "NUMERIC", "REAL", "DOUBLE")

# Spark types and the RDBMS type a new table gets for them.
RDBMS_DDL = {
    "tinyint": "INTEGER",
    "smallint": "INTEGER",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "DOUBLE PRECISION",
    "double": "DOUBLE PRECISION",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}

# The Spark type with which a catalog column of an RDBMS type is declared.
SPARK_OF_RDBMS = {
    "TEXT": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE PRECISION": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMPTZ": "timestamp",
    "DATE": "date",
}


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def _by_fragment(label: Column, position: int, fallback: str) -> Column:
    lowered = F.lower(F.coalesce(label, F.lit("")))
    result = F.lit(fallback)
    for rule in reversed(LABEL_FRAGMENTS):
        hit = F.lit(False)
        for fragment in rule[0]:
            hit = hit | lowered.contains(fragment)
        if rule[1] == "date":
            hit = hit & ~lowered.contains("time")
        result = F.when(hit, F.lit(rule[position])).otherwise(result)
    return result


def spark_type(label: Column) -> Column:
    """The Spark type of a logical label, by the fragments it contains."""
    return _by_fragment(label, 1, "string")


def rdbms_type(label: Column, style: str = "exact") -> Column:
    """The RDBMS type of a logical label, by exact match or by fragments."""
    if style == "fragment":
        return _by_fragment(label, 2, "TEXT")
    key = F.lower(F.btrim(label, F.lit(" \t\n\r\x0b\x0c")))
    return F.coalesce(_literal_map(RDBMS_TYPES)[key], F.lit("TEXT"))


def spark_of_rdbms(rdbms: Column) -> Column:
    """The Spark type that stands for an RDBMS type of T10 in catalog DDL."""
    return F.coalesce(_literal_map(SPARK_OF_RDBMS)[rdbms], F.lit("string"))


def rdbms_ddl_type(dtype: Column, style: str = "spark") -> Column:
    """The column type a new RDBMS table gets for a Spark type label.

    ``style="wide"`` keeps only the coarse classes: whole numbers, fractions,
    points in time, everything else text.
    """
    if style == "wide":
        return (
            F.when(dtype.isin("tinyint", "smallint", "int", "bigint"), "BIGINT")
            .when(dtype.isin("float", "double"), "DOUBLE PRECISION")
            .when(dtype.startswith("timestamp"), "TIMESTAMP")
            .otherwise("TEXT")
        )
    numeric = F.concat(F.lit("NUMERIC"), F.substring(dtype, 8, 100))
    return F.when(dtype.startswith("decimal"), numeric).otherwise(
        F.coalesce(_literal_map(RDBMS_DDL)[dtype], F.lit("TEXT"))
    )


def rdbms_ddl_name(dtype: str, style: str = "spark") -> str:
    """T11, T12 for one schema field; ``dtype`` is its ``simpleString``."""
    if style == "wide":
        if dtype in ("tinyint", "smallint", "int", "bigint"):
            return "BIGINT"
        if dtype in ("float", "double"):
            return "DOUBLE PRECISION"
        return "TIMESTAMP" if dtype.startswith("timestamp") else "TEXT"
    if dtype.startswith("decimal"):
        return "NUMERIC" + dtype.removeprefix("decimal")
    return RDBMS_DDL.get(dtype, "TEXT")


def type_label(label: Column) -> Column:
    """One spelling per type, so that labels can be compared."""
    plain = F.lower(F.btrim(F.coalesce(label, F.lit("")), F.lit(" \t\n\r\x0b\x0c")))
    return (
        F.when(plain.isin("int", "integer"), "integer")
        .when(plain == "long", "bigint")
        .when(plain.startswith("decimal"), "decimal")
        .otherwise(plain)
    )
