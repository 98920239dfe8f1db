import pytest
from navrecon import session


class Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if self.folder and key == "spark.checkpoint.dir" else default


class Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class Fake:
    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = Conf(folder), Context(master)


def test_the_clusters_folder_is_used():
    assert session.shared_dir(Fake("yarn", "hdfs://shared/x")) == "hdfs://shared/x"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake("yarn"))


def test_broadcast_only_below_the_limit(spark):
    small = session.broadcast_if_small(spark.range(10), max_rows=10)
    large = session.broadcast_if_small(spark.range(11), max_rows=10)
    plans = [df._jdf.queryExecution().analyzed().toString() for df in (small, large)]
    assert "broadcast" in plans[0] and "broadcast" not in plans[1]
