import pytest

from rowlake import workspace
from rowlake.sources import files


class Session:
    """A session of a master with settings, as far as the workspace asks."""

    def __init__(self, spark, master, folder=None):
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: folder if key == "spark.checkpoint.dir" else default})()
        context = type("Context", (), {"master": master, "applicationId": "app-1"})()
        context.getConf = lambda: self.conf
        self.sparkContext = context


def test_only_one_machine_may_do_without_the_setting(spark):
    assert workspace.shared_folder(Session(spark, "yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert workspace.shared_folder(Session(spark, "local[4]")).endswith("rowlake-app-1")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            workspace.shared_folder(Session(spark, master))


def test_no_setting_is_changed_and_folders_are_released(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    one, two = (workspace.new_folder(spark, "released") for _ in range(2))
    for folder in (one, two):
        spark.range(1).write.parquet(folder)
    assert spark.conf.get("spark.checkpoint.dir", None) == before
    assert workspace.release(spark, one) == [one]
    assert not files.exists(spark, one) and files.exists(spark, two)
    assert workspace.release(spark, two) == [two] and not files.exists(spark, two)
    assert workspace.release(spark, two) == []
