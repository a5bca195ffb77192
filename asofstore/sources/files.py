"""File sinks and sources: CSV with ';', published Parquet, partitioned bronze."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# NULL is written as this marker so that it stays distinct from an empty string.
NULL_MARK = "\\N"


def write_csv(df: DataFrame, path: str, sep: str = ";", compression: str | None = None) -> None:
    """CSV with header, no index, written by the executors (S4) -- never via the driver; ``compression``: a codec, as gzip."""
    (df.write.mode("overwrite").option("sep", sep).option("header", True).option("compression", compression or "none")
     .option("nullValue", NULL_MARK).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """CSV with a declared schema (no inference pass); adds ``year`` of ``dt_ref`` (S3)."""
    df = (spark.read.option("sep", sep).option("header", True).option("nullValue", NULL_MARK)
          .option("emptyValue", "").schema(schema).csv(path))
    if "dt_ref" in df.columns and "year" not in df.columns:
        df = df.withColumn("year", F.year("dt_ref").cast("int"))
    return df


REJECT = "reject_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", header: bool = True) -> DataFrame:
    """As :func:`read_csv`, with every line in the result: ``reject_line`` holds a line that has too few or too many
    fields or a value that does not fit its type, and is null for a good one. An empty
    field that is no text is null.

    Split it with ``reject_line IS NULL``; a rejected line's other columns hold what could be read of it.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    read = (spark.read.option("sep", sep).option("header", header).option("nullValue", NULL_MARK).option("emptyValue", "")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT).schema(whole).csv(path))
    # the reader checks the columns that are used; this uses them all, whatever the query selects
    used = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0
    return read.withColumn(REJECT, F.when(used, F.col(REJECT)))


# ------------------------------------------------------ published versions

POINTER = "CURRENT"


def publish(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write a new version folder under ``root``, then point to it; returns the version.

    The pointer is one small file that an atomic rename replaces, so a reader sees one whole version: the old
    one until the rename, the new one after it. Readers that have begun keep their version, as the newest
    ``keep`` versions stay. Parts are never funnelled into one file (one task).
    """
    spark, root = df.sparkSession, root.rstrip("/")
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"
    df.write.parquet(f"{root}/{version}")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    path = lambda name: hadoop.Path(f"{root}/{name}")
    fs = path(POINTER).getFileSystem(conf)
    out = fs.create(path(f"_{version}"), True)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(path(f"_{version}")), fs.makeQualified(path(POINTER)), overwrite)
    names = sorted(s.getPath().getName() for s in fs.listStatus(hadoop.Path(root)) if s.getPath().getName().startswith("v-"))
    for old in names[:-keep]:
        if old != published_version(spark, root):
            fs.delete(path(old), True)
    return version


def published_version(spark: SparkSession, root: str) -> str:
    return spark.read.text(f"{root.rstrip('/')}/{POINTER}").first()[0]


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The version that is current now."""
    return spark.read.parquet(f"{root.rstrip('/')}/{published_version(spark, root)}")


def write_sessions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Bronze sink partitioned by season, round and session type.

    Partition columns make season/round filters prune whole directories.
    """
    df.write.mode(mode).partitionBy("year", "roundnumber", "mode").parquet(path)
