import os

import pytest

from tickwise import session


class _Conf:
    def __init__(self, value, master="local[4]"):
        self.value, self.master = value, master

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.value, "spark.master": self.master}.get(key) or default


class _Ctx:
    def __init__(self, base=None):
        self.base, self.set_to = base, None

    def getCheckpointDir(self):
        return self.base

    def setCheckpointDir(self, d):
        self.set_to = d


class _Spark:
    def __init__(self, conf_value=None, ctx_base=None, master="local[4]"):
        self.conf = _Conf(conf_value, master)
        self.sparkContext = _Ctx(ctx_base)


def test_scratch_root_prefers_cluster_setting():
    s = _Spark(conf_value="hdfs://shared/ckpt/")
    assert session.scratch_root(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.set_to is None


def test_scratch_root_falls_back_to_context_then_local():
    s = _Spark(ctx_base="file:/shared/ckpt/abc")
    assert session.scratch_root(s) == "file:/shared/ckpt/abc"
    s = _Spark()
    root = session.scratch_root(s)
    assert os.path.isdir(root) and os.path.basename(root).startswith("run-")
    assert s.sparkContext.set_to == root


def test_scratch_dirs_are_fresh():
    s = _Spark(conf_value="/shared/ckpt")
    a, b = session.new_scratch_dir(s, "x"), session.new_scratch_dir(s, "x")
    assert a != b and a.startswith("/shared/ckpt/tickwise-x-")


def test_no_scratch_on_a_cluster_without_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        s = _Spark(master=master)
        with pytest.raises(RuntimeError):
            session.scratch_root(s)
        assert s.sparkContext.set_to is None
        assert session.scratch_root(_Spark(conf_value="/shared", master=master)) == "/shared"
