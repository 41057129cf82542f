"""Scratch-folder rules: the cluster's shared folder, never a machine-local one."""

import pytest

from revmart.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf=None, ckpt=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._ckpt = ckpt

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master)


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_configured_shared_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert scratch_path(s, "bronze").startswith("hdfs://nn/shared/ckpt/revmart/bronze-")
    assert scratch_path(s, "bronze") != scratch_path(s, "bronze")  # never reused


def test_local_master_gets_a_local_folder():
    s = _Session("local[2]")
    root = checkpoint_root(s)
    assert root and s.sparkContext.getCheckpointDir() == root
