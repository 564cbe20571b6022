"""Staged tables and the shared checkpoint folder."""

import os
from types import SimpleNamespace

import pytest

from thermolytics.session import checkpoint_root, materialize, release, scratch


def session(master, conf=None):
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: (conf or {}).get(k, d)), sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,512]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session(master))
    assert checkpoint_root(session(master, {"spark.checkpoint.dir": "hdfs:///x"})) == "hdfs:///x"


def test_local_masters_fall_back():
    assert checkpoint_root(session("local[8]")) == checkpoint_root(session("local"))


def test_settings_are_left_alone(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    checkpoint_root(spark)
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_release_removes_only_staged_tables(spark, tmp_dir):
    df, n = materialize(spark.range(10), "kept", count=True)
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert n == 10 and os.path.isdir(folder)
    release(df)
    assert not os.path.exists(folder)
    spark.range(3).write.parquet(f"{tmp_dir}/own")
    own = spark.read.parquet(f"{tmp_dir}/own")
    release(own)
    assert own.count() == 3


def test_a_job_leaves_no_staged_tables(spark):
    root = checkpoint_root(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with scratch(spark):
        assert materialize(spark.range(5), "job").count() == 5
        assert set(os.listdir(root)) != before
    assert set(os.listdir(root)) == before
