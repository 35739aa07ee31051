"""Session helpers: settings are only filled in, stages are materialised."""

import os

from pyspark.sql import functions as F

from yoyflow.session import RECOMMENDED, configure, cut_lineage, drop_stages, ensure_checkpoint_dir, stage_root


def test_configure_keeps_existing_settings(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        configure(spark)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)
    assert set(RECOMMENDED) >= {"spark.sql.adaptive.enabled", key}


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    assert spark.sparkContext.getCheckpointDir() is not None


class _Context:
    """Just the calls that ``ensure_checkpoint_dir`` makes."""

    def __init__(self, app, master="local[2]", own=None, configured=None):
        self.applicationId, self.master, self._own, self._configured, self.calls = app, master, own, configured, []

    def getConf(self):
        return {"spark.checkpoint.dir": self._configured} if self._configured else {}

    def getCheckpointDir(self):
        return self._own

    def setCheckpointDir(self, path):
        self.calls.append(path)
        self._own = f"{path}/some-id"


class _Session:
    def __init__(self, context):
        self.sparkContext, self.conf = context, {}


def test_folder_set_by_the_caller_is_kept():
    sc = _Context("app-caller", own="hdfs://x/y/one-id")
    assert ensure_checkpoint_dir(_Session(sc)) == "hdfs://x/y" and sc.calls == []
    assert stage_root(_Session(sc)).startswith("hdfs://x/y/")


def test_one_scratch_folder_per_local_application():
    s = _Session(_Context("app-local"))
    assert stage_root(s) == stage_root(s) and len(s.sparkContext.calls) == 1


def test_unset_folder_on_a_cluster_is_an_error():
    import pytest

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("app-cluster", master="spark://host:7077")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("app-cluster-2", master="local-cluster[2,1,1024]")))


def test_drop_stages_deletes_what_was_written(spark):
    out = cut_lineage(spark.range(10))
    assert out.count() == 10
    root = stage_root(spark)
    assert os.path.isdir(root.removeprefix("file:"))
    drop_stages(spark)
    assert not os.path.exists(root.removeprefix("file:"))
    drop_stages(spark)


def test_cut_lineage_modes(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    for how in ("table", "checkpoint", "persist", "none"):
        out = cut_lineage(df.where("id % 3 = 0"), how)
        assert out.count() == 34 and out.agg(F.sum("x")).first()[0] == sum(2 * i for i in range(0, 100, 3))
    root = stage_root(spark)
    if root.startswith("/"):
        assert os.path.isdir(root)
