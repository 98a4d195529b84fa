"""Checkpoint folder: taken from the session; a private folder only in local mode."""

import pytest

from pavespark.session import ensure_checkpoint_dir


class _SC:
    def __init__(self, master, current=None):
        self.master, self._dir, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self.set_to, self._dir = d, d


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value if self.value is not None else default


class _Spark:
    def __init__(self, master, conf_dir=None, current=None):
        self.sparkContext, self.conf = _SC(master, current), _Conf(conf_dir)


def test_uses_existing_checkpoint_dir():
    s = _Spark("yarn", current="hdfs://shared/ckpt/abc")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt/abc" and s.sparkContext.set_to is None


def test_reads_cluster_setting():
    s = _Spark("yarn", conf_dir="s3a://bucket/ckpt")
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_private_folder_only_in_local_mode():
    s = _Spark("local[4]")
    d = ensure_checkpoint_dir(s)
    assert d and "pavespark-ckpt-" in d
