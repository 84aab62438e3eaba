"""Table schemas as evidence (V1-V3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowlake.functions.naming import operation_table_name, physical_table_name
from rowlake.sources.lake import Lake

ATTRIBUTES = "array<struct<name string, logical_type string, physical_type string, nullable boolean>>"


def describe(catalog: DataFrame) -> DataFrame:
    """V1, V2: one row per column of every table in a catalog frame."""
    return catalog.where(F.col("name").isNotNull()).select(
        "table_name",
        "ordinal",
        "name",
        F.col("dtype").alias("logical_type"),
        F.col("dtype").alias("physical_type"),
        "nullable",
    )


def introspect(lake: Lake) -> DataFrame:
    """V1 for all tables of a lake at once."""
    return describe(lake.catalog())


def _attributes(columns: DataFrame) -> DataFrame:
    """(table_name, attributes in ordinal order, schema as ``name:type``)."""
    entry = F.struct("ordinal", "name", "logical_type", "physical_type", "nullable")
    grouped = columns.groupBy("table_name").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return grouped.select(
        "table_name",
        F.transform(
            "entries",
            lambda e: F.struct(*[e[n].alias(n) for n in ("name", "logical_type", "physical_type", "nullable")]),
        ).alias("attributes"),
        F.transform("entries", lambda e: F.concat_ws(":", e["name"], e["logical_type"])).alias("schema"),
    )


def evidence(requests: DataFrame, lake: Lake, naming: str = "ingest") -> DataFrame:
    """V3 for lake tables: ``requests(correlation_id, plan_id, dataset_id)`` answered in one job."""
    rule = operation_table_name if naming == "operation" else physical_table_name
    known = _attributes(introspect(lake))
    asked = requests.withColumn("table_name", rule(F.col("dataset_id")))
    path = F.concat_ws("/", F.lit(lake.root), "table_name")
    found = F.to_json(
        F.struct(
            F.lit("delta").alias("backend"), "table_name", path.alias("path"),
            F.transform("attributes", lambda a: a["name"]).alias("columns"), "schema",
        )
    )
    missing = F.to_json(
        F.struct(F.lit("delta").alias("backend"), "table_name", F.lit(False).alias("exists"), path.alias("path"))
    )
    return _answer(asked.join(known, "table_name", "left"), F.col("table_name"), found, missing)


def evidence_rdbms(requests: DataFrame, catalog: DataFrame, default_schema: str = "public") -> DataFrame:
    """V3 for RDBMS tables, given their catalog frame with ``schema.table`` names."""
    known = _attributes(describe(catalog))
    name = operation_table_name(F.col("dataset_id"), "rdbms")
    asked = requests.withColumns(
        {
            "schema_name": F.lit(default_schema),
            "bare_name": name,
            "table_name": F.concat_ws(".", F.lit(default_schema), name),
        }
    )
    head = [F.lit("rdbms").alias("backend"), F.col("schema_name").alias("schema"), F.col("bare_name").alias("table_name")]
    names = F.transform("attributes", lambda a: a["name"]).alias("columns")
    return _answer(
        asked.join(known.drop("schema"), "table_name", "left"),
        F.col("table_name"),
        F.to_json(F.struct(*head, F.lit(True).alias("exists"), names)),
        F.to_json(F.struct(*head, F.lit(False).alias("exists"))),
    )


def _answer(joined: DataFrame, name, found, missing) -> DataFrame:
    """The response fields; the list of vault structures is always empty."""
    present = F.col("attributes").isNotNull()
    tables = F.array(F.struct(name.alias("name"), "attributes"))
    return joined.select(
        "correlation_id",
        "plan_id",
        F.when(present, tables).otherwise(F.array().cast(f"array<struct<name string, attributes {ATTRIBUTES}>>")).alias("tables"),
        F.array().cast("array<string>").alias("vault_structures"),
        F.when(present, found).otherwise(missing).alias("raw_evidence_json"),
    )
