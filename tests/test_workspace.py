import pytest

from snaplake.workspace import shared_dir


class FakeSession:
    def __init__(self, master, setting=None):
        self.sparkContext = self.conf = self
        self.master, self.setting = master, setting

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return None


def test_the_cluster_names_the_folder(spark):
    assert shared_dir(FakeSession("yarn", "hdfs:///shared/"), "a", "b").startswith("hdfs:///shared/a/b/")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("spark://head:7077"))
    assert "snaplake-" in shared_dir(FakeSession("local[2]"))
