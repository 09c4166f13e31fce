"""Session construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "newslab", shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE, UTC and the UI off.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the
    submit configuration; the defaults below are applied only to keys the
    submit configuration leaves unset.
    """
    from pyspark import SparkConf, SparkContext

    cpus = os.environ.get("BENCH_CPUS", "8")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus)),
        "spark.driver.memory": os.environ.get("NEWSLAB_DRIVER_MEMORY", "8g"),
    }
    SparkContext._ensure_initialized()
    submitted = SparkConf()  # settings given to spark-submit / the launcher
    builder = SparkSession.builder.appName(app)
    for key, value in defaults.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    elif not submitted.contains("spark.master"):
        builder = builder.master(f"local[{cpus}]")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster setting always wins.  A session without one gets a local folder
    only if its master is local (tests and local runs); elsewhere executors could
    not see it, so the setting is asked for.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="newslab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    # getCheckpointDir returns a per-application subfolder; keep the root.
    return spark.conf.get("spark.checkpoint.dir", path)


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/newslab/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under this application's part of the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder made at a ``scratch_path`` that no later step reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application has written under ``scratch_path``; call it before the session stops."""
    remove(spark, _scratch_root(spark))
