"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames. These helpers are for tests, the bench and the entry point.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness of the oracle comparison (UTC dates)
# and for plan quality at any scale (AQE re-plans joins and partition counts
# from runtime statistics, skew join splits hot partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "asofstore", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("ASOF_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; without it this is an error, as a folder of one machine would be lost
    with it. Only a local master gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[[^-]*\])?$", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    path = tempfile.mkdtemp(prefix="asof-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A per-use folder under the shared checkpoint folder, removed when the application ends.

    Used for written intermediate tables that must survive executor loss.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    parent = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    fs = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return f"{parent.toString()}/t"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
