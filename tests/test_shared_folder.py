"""Where checkpoints and scratch tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from assayline.operators.lookup import shared_folder


class Context:
    def __init__(self, master: str) -> None:
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder: str) -> None:
        self.folder = folder


def session(master: str, **settings: str) -> SimpleNamespace:
    values = {name.replace("_", "."): value for name, value in settings.items()}
    conf = SimpleNamespace(get=lambda name, default=None: values.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_the_named_folder_comes_first():
    spark = session("spark://host:7077", spark_checkpoint_dir="hdfs://store/c", spark_sql_warehouse_dir="file:/w")
    assert shared_folder(spark) == "hdfs://store/c"
    assert spark.sparkContext.folder == "hdfs://store/c"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_uses_its_warehouse(master):
    spark = session(master, spark_sql_warehouse_dir="file:/w/")
    assert shared_folder(spark) == "file:/w/_scratch"
    assert shared_folder(spark) == "file:/w/_scratch"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://host:7077"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master, spark_sql_warehouse_dir="file:/w"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master, spark_sql_warehouse_dir="/w"))
    assert shared_folder(session(master, spark_sql_warehouse_dir="s3a://w")) == "s3a://w/_scratch"
