"""The two requests a lake answers, for either backend."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowlake.functions.naming import operation_table_name
from rowlake.operators import evidence, evolve
from rowlake.sources.lake import Lake
from rowlake.sources.rdbms import Rdbms


def apply_operations(ops: DataFrame, target: Lake | Rdbms, **options) -> DataFrame:
    """One result per operation, in a frame with the request's ``seq``."""
    if isinstance(target, Rdbms):
        return target.apply_operations(ops, **options)
    return evolve.apply_operations(ops, target, **options)


def introspect_evidence(requests: DataFrame, target: Lake | Rdbms) -> DataFrame:
    """V3: ``requests(correlation_id, plan_id, dataset_id)`` answered from the catalog."""
    if isinstance(target, Lake):
        return evidence.evidence(requests, target)
    tables = requests.select(operation_table_name(F.col("dataset_id"), "rdbms").alias("t")).distinct()
    schema = target.default_schema
    found = target.columns((schema, name) for name in target.named(tables, "t"))
    return evidence.evidence_rdbms(requests, found, schema)
