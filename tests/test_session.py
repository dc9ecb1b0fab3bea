from types import SimpleNamespace

import pytest

from marquee.session import new_folder, shared_dir


class Context:
    def __init__(self, master, named=None):
        self.master, self.named, self.set_to = master, named, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.named} if self.named else {}

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, path):
        self.set_to = path


def session(*args):
    return SimpleNamespace(sparkContext=Context(*args))


def test_the_named_folder_is_used_and_set_once():
    spark = session("yarn", "hdfs://shared/work/")
    assert shared_dir(spark) == "hdfs://shared/work"
    assert spark.sparkContext.set_to == "hdfs://shared/work/"
    assert new_folder(spark, "x").startswith("hdfs://shared/work/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_a_local_master_gets_a_temporary_folder():
    assert "marquee-" in shared_dir(session("local[2]"))
