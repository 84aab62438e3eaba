"""Labels for the classifiers: who may be learned from, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rowlake.llm.common import cut


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a row's labels are kept from learning; rows without an id have no labels."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def usable(labels: DataFrame, column: str, modulus: int, remainder: int) -> DataFrame:
    """``doc_id, label`` of all documents that are not held out; several labels count as the lowest, null ones as none."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out(modulus, remainder))
        .groupBy(F.col("doc_id").try_cast("bigint").alias("doc_id")).agg(F.min(column).cast("int").alias("label"))
    )


def sample(labels: DataFrame, column: str, modulus: int, remainder: int, per_class: int) -> DataFrame:
    """``doc_id, label`` of at most ``per_class`` documents of either label that are not held out, by a hash of the id.

    Several labels of one document count as the lowest; null labels as none.
    """
    order = F.xxhash64("doc_id")
    all_usable = usable(labels, column, modulus, remainder)
    taken = [all_usable.where(F.col("label") == x).orderBy(order, "doc_id").limit(per_class) for x in (0, 1)]
    return cut(taken[0].union(taken[1]))


def documents_of(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``doc_id, label, text``: the sampled documents, one text per id (the one of the smallest hash).

    ``labelled`` is bounded by :func:`sample`, so it may be broadcast.
    """
    rows = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    met = rows.join(F.broadcast(labelled), "doc_id")
    return met.groupBy("doc_id", "label").agg(F.min_by("text", F.md5("text")).alias("text"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
