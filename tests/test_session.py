"""Checkpoint folder rule: the session's setting wins; a local temp folder only for local masters."""

import pytest

from sensorlytics.session import ensure_checkpoint_dir, local_path


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Ctx:
    def __init__(self, master, current=None, conf=None):
        self.master, self._dir, self._conf = master, current, _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, ctx, conf=None):
        self.sparkContext, self.conf = ctx, _Conf(conf or {})


def test_existing_checkpoint_dir_wins():
    s = _Spark(_Ctx("yarn", current="hdfs://nn/ckpt/app"))
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt/app"


def test_configured_dir_is_used():
    s = _Spark(_Ctx("k8s://x"), {"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark(_Ctx("yarn")))


def test_local_master_gets_a_temporary_folder():
    d = ensure_checkpoint_dir(_Spark(_Ctx("local[2]")))
    assert "sensorlytics-ckpt-" in d


def test_local_path():
    assert local_path("file:/tmp/x") == "/tmp/x"
    assert local_path("file:///tmp/x") == "/tmp/x"
