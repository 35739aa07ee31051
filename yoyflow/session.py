"""Session helpers: recommended settings and lineage cutting.

The library never creates its own session inside an operator; jobs receive the
caller's ``SparkSession``.  ``configure`` only fills settings that are unset, so
a cluster's own choices always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# Settings the jobs are designed around.  Applied only where the session has
# no value of its own.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # operators/joins.py: without it an aggregate joined back on its keys cannot be split
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # the JVM never compiles a method of more bytes: the extract's rule tables, joined into
    # one generated method, would be interpreted row by row
    METHOD_LIMIT: "8000",
}


def _is_set(spark: SparkSession, key: str) -> bool:
    try:
        return spark.conf.get(key, None) not in (None, "")
    except Exception:  # pragma: no cover - conf lookups never fail in practice
        return False


def configure(spark: SparkSession, keys: Collection[str] = tuple(RECOMMENDED)) -> SparkSession:
    for key in keys:
        if not _is_set(spark, key):
            spark.conf.set(key, RECOMMENDED[key])
    return spark


# Application id -> folder for stage tables, resolved once per application.
_stage_base: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the application's shared folder for stages and checkpoints.

    In this order: ``spark.checkpoint.dir`` of the session or of the Spark
    conf, the folder a caller has set with ``setCheckpointDir``, and, only
    where all executors run in this machine's one process (``local`` masters),
    a scratch folder.  Anywhere else a missing setting is an error: a folder of
    the driver's machine is not visible to the executors.  The answer is kept
    for the life of the application, and a folder the caller has set is never
    replaced.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        _stage_base[sc.applicationId] = configured
        return configured
    known = _stage_base.get(sc.applicationId)
    if known:
        return known
    own = sc.getCheckpointDir()
    if own is None:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="yoyflow-ckpt-")
        sc.setCheckpointDir(own)
    else:
        own = own.rstrip("/").rsplit("/", 1)[0]  # Spark appends a folder of its own
    _stage_base[sc.applicationId] = own
    return own


def cut_lineage(df: DataFrame, how: str = "table") -> DataFrame:
    """Materialise a stage that is read several times.

    ``table``       write the stage as parquet under the session's checkpoint
                    folder and read it back: computed once, survives executor
                    loss, and the read-back prunes columns and carries real size
                    statistics for adaptive join planning (default);
    ``checkpoint``  Spark's reliable RDD checkpoint (persisted first so the
                    stage is not computed twice);
    ``persist``     executor memory and disk only (recomputed from lineage if
                    an executor is lost);
    ``none``        leave the plan untouched.
    """
    if how == "table":
        path = new_stage(df.sparkSession)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    if how == "checkpoint":
        from pyspark import StorageLevel

        ensure_checkpoint_dir(df.sparkSession)
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        out = kept.checkpoint(eager=True)
        kept.unpersist()
        return out
    if how == "persist":
        from pyspark import StorageLevel

        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "none":
        return df
    raise ValueError(f"unknown materialisation {how!r}")


STAGE_FOLDER = "yoyflow-stages"


def stage_root(spark: SparkSession) -> str:
    """Folder of this application's stage tables (one per application, so
    concurrent jobs sharing a checkpoint folder never touch each other's)."""
    app = spark.sparkContext.applicationId
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{STAGE_FOLDER}/{app}"


def new_stage(spark: SparkSession) -> str:
    """A fresh path for one stage table of this application."""
    return f"{stage_root(spark)}/{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through its Hadoop file system (a no-op if it is absent)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.delete(target, True)


def drop_stages(spark: SparkSession) -> None:
    """Delete this application's stage tables (call once the results are written).

    Uses the Hadoop FileSystem of the checkpoint folder, so it works the same
    on HDFS, object stores and local disk.
    """
    drop_path(spark, stage_root(spark))


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark (never used by the library)."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("yoyflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
