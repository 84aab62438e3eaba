import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    from rowlake import workspace
    from rowlake.sources.lake import Lake

    return Lake(spark, workspace.new_folder(spark, f"test-{uuid.uuid4().hex}"))


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


def rows(frame, *order):
    return [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]
