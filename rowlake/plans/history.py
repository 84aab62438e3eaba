"""What the batches of a lake have held: their profiles, kept and merged.

The types of a table are those of its first batch. Each batch may also leave
its profile, one row per table and column, in a table of its own below the
lake's reserved folder, in a directory named by the batch: a batch that is run
again replaces its profile as it replaces its rows. Profiles are merged when
they are read, by one aggregate, so nothing is read and written back per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowlake.operators.profile import PROFILE_SCHEMA, as_kept, merged
from rowlake.operators.shape import MIN_DATE_SHARE
from rowlake.sources.envelope import INGESTION_TIMESTAMP
from rowlake.sources.lake import RESERVED, Lake, Written

PROFILES = "profiles"


def system_lake(lake: Lake) -> Lake:
    """The lake's own tables, which are not among its tables."""
    return Lake(lake.spark, f"{lake.root}/{RESERVED}")


def keep_profile(lake: Lake, profile: DataFrame, source: str, batch_id: int) -> Written:
    # One row per column of a batch: a single small file.
    return system_lake(lake).append(PROFILES, as_kept(profile).coalesce(1), source, batch_id)


def merged_profile(lake: Lake, min_conf: float = MIN_DATE_SHARE) -> DataFrame:
    """Per table and column, the counts, the first value and the verdict over all kept batches."""
    own = system_lake(lake)
    kept = own.scan(PROFILES) if own.state(PROFILES) else lake.spark.createDataFrame([], PROFILE_SCHEMA)
    return merged(kept, min_conf).where("column_name is not null")


def drifted(lake: Lake, min_conf: float = MIN_DATE_SHARE) -> DataFrame:
    """Columns whose declared type is not what all batches together say: ``table_name, column_name, declared, verdict``."""
    declared = lake.catalog().select("table_name", F.col("name").alias("column_name"), F.col("dtype").alias("declared"))
    found = declared.join(merged_profile(lake, min_conf), ["table_name", "column_name"])
    changed = (F.col("declared") != F.col("verdict")) & F.col("declared").isin("date", "string")
    return found.where(changed & (F.col("column_name") != INGESTION_TIMESTAMP)).select("table_name", "column_name", "declared", "verdict")
