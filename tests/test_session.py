"""Session helpers: cluster settings and the shared checkpoint folder."""

import pytest

from tarmac.session import cluster_conf, ensure_checkpoint_dir, scratch_path


def test_cluster_conf_sizes_with_the_cluster():
    conf = cluster_conf(executors=1000, cores_per_executor=4)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(conf["spark.sql.shuffle.partitions"]) == 16000
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]
    assert not any(k.startswith("spark.ui.") for k in conf)


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)


class _Ctx:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master):
        self.sparkContext = _Ctx(master)
        self.conf = _Conf()


def test_no_machine_local_checkpoint_on_a_cluster():
    with pytest.raises(RuntimeError, match="shared storage"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_scratch_paths_are_fresh_and_shared(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    root = spark.sparkContext.getCheckpointDir()
    assert a != b and a.startswith(root) and b.startswith(root)
