from types import SimpleNamespace

import pytest

from hustings.session import fresh_path, materialise, shared_folder


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, folder=None, setting=None):
    return SimpleNamespace(sparkContext=Context(master, folder), conf=SimpleNamespace(get=lambda key, default: setting or default))


def test_the_folder_comes_from_the_session():
    named = session("spark://host:7077", setting="hdfs://shared/checkpoints")
    assert shared_folder(named) == "hdfs://shared/checkpoints" == named.sparkContext.folder
    assert shared_folder(session("yarn", folder="hdfs://set")) == "hdfs://set"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("local-cluster[2,1,1024]"))


def test_a_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_materialised_rows_are_cut_from_their_source(spark):
    df = materialise(spark.range(5).withColumnRenamed("id", "x"))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
