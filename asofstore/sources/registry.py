"""Model registry and run log as plain tables."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_model(registry: DataFrame, name: str) -> DataFrame:
    """``(name, version, path)`` of the newest version of ``name``: numeric max of a string."""
    r = registry.where(F.col("name") == name)
    return r.groupBy("name").agg(
        F.max_by("version", F.col("version").cast("int")).alias("version"),
        F.max_by("path", F.col("version").cast("int")).alias("path"))


_ONE_AT_A_TIME = threading.Lock()


def next_version(spark: SparkSession, registry_path: str, name: str) -> str:
    """A version number that is nobody else's: the first whose marker file could be created.

    A marker is created only where there is none, which the store decides; threads of one driver take turns.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{registry_path.rstrip('/')}/_versions/{name}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    with _ONE_AT_A_TIME:
        fs.mkdirs(folder)
        taken = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
        version = max(taken, default=0) + 1
        while not fs.createNewFile(hadoop.Path(folder, str(version))):
            version += 1
    return str(version)


def register_model(registry_path: str, model, name: str, models_path: str, spark: SparkSession) -> str:
    """Save a fitted PipelineModel as the next version and append its registry row."""
    version = next_version(spark, registry_path, name)
    path = f"{models_path.rstrip('/')}/{name}-{version}"
    model.write().overwrite().save(path)
    spark.createDataFrame([(name, version, path)], "name string, version string, path string") \
        .write.mode("append").parquet(registry_path)
    return version
