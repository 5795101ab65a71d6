"""The folder of work tables."""

import pytest

from qalathe import session


class Settings:
    def __init__(self, named=None):
        self.named = named

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.named or default


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None):
        self.conf, self.sparkContext = Settings(named), Context(master)


def test_a_named_folder_is_used():
    assert session.shared_dir(Session("spark://host:7077", "hdfs://shared/work")) == "hdfs://shared/work"


def test_a_cluster_without_a_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            session.shared_dir(Session(master))


def test_a_local_master_gets_a_temporary_folder():
    local = Session("local[4]")
    made = session.shared_dir(local)
    assert made and session.shared_dir(local) == made
