"""Evidence ids (E9) and the classes of database errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The SQL state of a missing relation, and texts of errors that pass.
MISSING_RELATION_STATE = "42P01"
TRANSIENT_MARKERS = [
    "could not connect",
    "connection refused",
    "connection reset",
    "terminating connection",
    "the database system is starting up",
    "timeout",
    "timed out",
    "temporary failure",
    "no route to host",
    "server closed the connection",
]


def evidence_id(target: Column, plan_id: Column, idempotency_key: Column) -> Column:
    """The key under which the evidence of an operation is kept."""
    def part(value: Column, default: str) -> Column:
        return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))

    return F.concat_ws(
        ":", F.lit("lake"), part(target, "unknown"), part(plan_id, "no_plan"), part(idempotency_key, "no_idem")
    )


def is_missing_relation(message: Column, state: Column | None = None) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    by_text = text.contains("does not exist") & (text.contains("relation") | text.contains("table"))
    if state is None:
        return by_text
    return by_text | (F.coalesce(state, F.lit("")) == MISSING_RELATION_STATE)


def is_transient(message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    hit = F.lit(False)
    for marker in TRANSIENT_MARKERS:
        hit = hit | text.contains(marker)
    return hit


def error_class(message: Column, state: Column | None = None) -> Column:
    """``missing_relation``, ``transient`` or ``permanent``."""
    return (
        F.when(is_missing_relation(message, state), "missing_relation")
        .when(is_transient(message), "transient")
        .otherwise("permanent")
    )
