"""The shared folder, and what is left in it."""

import os

import pytest

from wayfare import session


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Application:
    def __init__(self, master, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})
        self.sparkContext = self
        self.master = master
        self.applicationId = f"test-{id(self)}"


def test_the_setting_names_the_folder():
    assert session.shared_dir(Application("yarn", spark__checkpoint__dir="hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Application("spark://host:7077"))


def test_a_local_session_has_a_folder_of_its_own():
    application = Application("local[2]")
    folder = session.shared_dir(application)
    assert os.path.isdir(folder) and session.shared_dir(application) == folder


def test_written_tables_are_read_back(spark):
    df = session.written(spark.range(10).toDF("n"), "numbers")
    assert sorted(r.n for r in df.collect()) == list(range(10))
    assert all(f"/wayfare/{spark.sparkContext.applicationId}/numbers-" in f for f in df.inputFiles())


def test_a_stream_session_leaves_the_callers_settings(spark):
    sibling = session.stream_session(spark)
    assert sibling.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in sibling.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    assert sibling.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_scratch_goes_with_its_round(spark):
    with session.scratch(spark):
        path = session.shared_path(spark, "t")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(path.removeprefix("file:"))
    assert "round-" not in session.shared_path(spark, "t")
