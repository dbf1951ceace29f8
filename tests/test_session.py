import pytest

from wardstar.session import checkpoint_dir


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, key, default=None):
        return self.d.get(key, default)


class _Ctx:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Ctx(master, conf or {})


def test_cluster_needs_shared_checkpoint_folder():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("yarn"))


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_local_mode_gets_a_private_folder():
    s = _Session("local[4]")
    d = checkpoint_dir(s)
    assert d and s.sparkContext.dir == d
