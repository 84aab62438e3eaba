"""Expressions that are made once."""

from __future__ import annotations

from functools import lru_cache, wraps

from pyspark import SparkContext

#: Expressions of a function that are kept.
KEPT = 256


def built_once(make):
    """Keeps what a function makes of plain values, for each JVM.

    Each node of an expression is some calls into the JVM; those of a micro-batch took longer than
    its jobs. An expression belongs to no frame, so that the next batch can use it again.
    """

    @lru_cache(maxsize=KEPT)
    def made(jvm, *values):
        return make(*values)

    @wraps(make)
    def known(*values):
        return made(SparkContext._active_spark_context._jvm, *values)

    return known
