"""Session helpers.

Settings that matter at any scale are set here once: UTC session zone
(dates are compared as ISO text), adaptive execution (runtime coalescing,
skew-join splitting, size-checked broadcast conversion) and a shared
checkpoint directory.  On a cluster the checkpoint directory comes from
``spark.checkpoint.dir``; we only fill it in when it is unset (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "matchlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a scratch one only when
    the cluster did not name one (local runs and tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="matchlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table below the checkpoint directory that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the checkpoint directory (Spark
    gives each application a folder of its own there).  Call it once results are
    consumed; every stored layer is gone afterwards."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        path = spark._jvm.org.apache.hadoop.fs.Path(current)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        spark.sparkContext.setCheckpointDir(os.path.dirname(current.rstrip("/")))
