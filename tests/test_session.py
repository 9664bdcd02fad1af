import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir, shared_table


class FakeSession:
    """A session whose settings can be chosen."""

    def __init__(self, master, configured=None, current=None):
        self.master, self.configured, self.current = master, configured, current
        self.sparkContext = self.conf = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_folder_of_the_cluster_is_used():
    session = FakeSession("spark://host:7077", "hdfs://shared/x")
    assert shared_dir(session) == "hdfs://shared/x"
    assert session.current == "hdfs://shared/x"


def test_checkpoint_folder_that_is_set_stays():
    session = FakeSession("yarn", "hdfs://shared/x", "hdfs://shared/x/app")
    assert shared_dir(session) == "hdfs://shared/x"
    assert session.current == "hdfs://shared/x/app"


def test_a_cluster_gets_no_machine_local_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))


def test_a_local_master_may_use_a_temporary_folder():
    session = FakeSession("local[2]")
    assert shared_dir(session) == session.current


def test_shared_table_is_read_back_whole(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS r", "cast(id AS string) AS t")
    table = shared_table(df)
    assert table.exceptAll(df).count() == 0
    assert table.count() == 100
    assert table.schema == df.schema or table.dtypes == df.dtypes
    assert all(shared_dir(spark) in file for file in table.inputFiles())


def test_what_a_table_shuffled_is_deleted_with_its_end(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    folders = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {path for folder in folders for path in Path(folder).rglob("shuffle_*")}

    there = shuffled()
    table = shared_table(spark.range(1000).groupBy((F.col("id") % 7).alias("r")).count())
    until = time.time() + 20
    while shuffled() - there and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - there
    assert sorted(map(tuple, table.collect())) == [(n, 143 if n < 6 else 142) for n in range(7)]
    assert spark.conf.get(setting, None) == before
