"""Where a job may put the tables it writes on the way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from rowlake.sources import files

_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a session whose driver is its one executor may do without the setting;
    it has a folder named by its application. Elsewhere a missing setting is an
    error, not a reason to use a local disk. No setting is changed.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"rowlake-{context.applicationId}")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    folder = f"{shared_folder(spark)}/rowlake/{purpose}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def release(spark: SparkSession, *folders: str) -> list[str]:
    """Remove folders of this session, or all of them, once no result is read from them any more."""
    made = _made.get(spark.sparkContext.applicationId, [])
    gone = [f for f in made if not folders or f in folders]
    for folder in gone:
        made.remove(folder)
        files.delete(spark, folder)
    return gone
