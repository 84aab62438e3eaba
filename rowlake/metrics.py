"""Counts that Spark takes while it runs a job anyway."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observation(purpose: str) -> Observation:
    return Observation(f"{purpose}-{uuid.uuid4().hex}")


def taken(observed: Observation) -> dict:
    """The counts, once the job is done; none if Spark found the plan to be empty and counted nothing."""
    try:
        return observed.get
    except Py4JJavaError as error:
        # Spark asserts that there is a row of counts; an empty plan has none.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}
