"""Keyed upsert (merge) into a partitioned Parquet table.

Plain Parquet has no MERGE. Incoming rows are written to a staging folder once
and checked there; the partitions that they touch (where they go, and where
their keys are now) are recomputed into a second staging folder, whose partitions are moved
into their place, and staging is removed. The table path is never written while it is read, and
other partitions are not touched.

A run that stops before the swap leaves the table as it was; one that stops
during the swap is repaired by running it again with the same rows. A key may be
NULL (NULL equals NULL) and its partition value may be NULL or change: the old
row goes. Duplicate keys in the incoming rows are an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _has_rows(spark: SparkSession, path: str) -> bool:
    """A folder without a data file is no table."""
    if not _exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def partition_folder(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder that the writer gives a partition value (as string), escaped as it does."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{escape(column)}={escape(value) if value else '__HIVE_DEFAULT_PARTITION__'}"


def _swap_folders(spark: SparkSession, new: str, table: str, there: set[str], was: str) -> None:
    """Put the partition folders of ``new`` in the place of the table's, and take away those of ``there`` that it lacks. A
    folder that cannot be put in place leaves the old one there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(new)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = {f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()}
    fs.mkdirs(hadoop.Path(was))
    for name in sorted(made | there):
        # the name is escaped already, as a Path takes it
        place, kept = hadoop.Path(hadoop.Path(table), name), hadoop.Path(hadoop.Path(was), name)
        old = fs.exists(place)
        if old and not fs.rename(place, kept):
            raise OSError(f"{place.toString()} cannot be moved")
        if name in made and not fs.rename(hadoop.Path(at, name), place):
            if old:
                fs.rename(kept, place)
            raise OSError(f"{place.toString()} cannot be replaced")
        fs.delete(kept, True)


def upsert(spark: SparkSession, table_path: str, incoming: DataFrame, keys: list[str],
           partition_col: str, staging_root: str | None = None) -> None:
    """Merge ``incoming`` (which holds ``partition_col``) into the table on ``keys``;
    its rows win. ``incoming`` is evaluated once."""
    replace_rows(spark, table_path, incoming, None, keys, partition_col, staging_root)


def replace_rows(spark: SparkSession, table_path: str, incoming: DataFrame, doomed: DataFrame | None, keys: list[str],
                 partition_col: str, staging_root: str | None = None) -> None:
    """Put ``incoming`` in the place of the rows whose keys are in ``doomed``, whether or not it has such keys.

    Without ``doomed`` these are the keys of ``incoming``, which must then be unique; with ``incoming`` itself as
    ``doomed`` its keys may repeat. Both are evaluated once.
    """
    root = f"{(staging_root or table_path).rstrip('/')}.__staging-{uuid.uuid4().hex[:10]}"
    try:
        incoming.write.parquet(f"{root}/incoming")
        new = spark.read.schema(incoming.schema).parquet(f"{root}/incoming")
        if doomed is None:
            double = new.groupBy(*keys).count().where("count > 1").drop("count").limit(1).collect()
            if double:
                raise ValueError(f"duplicate key in the incoming rows: {double[0].asDict()}")
            out_keys = new.select(*keys)
        else:
            (new if doomed is incoming else doomed).select(*keys).distinct().write.parquet(f"{root}/doomed")
            out_keys = spark.read.schema(new.select(*keys).schema).parquet(f"{root}/doomed")
        if not _has_rows(spark, table_path):
            new.write.mode("overwrite").partitionBy(partition_col).parquet(table_path)
            return
        table = spark.read.schema(new.schema).parquet(table_path)
        # keys are joined by exchange: as a broadcast they would go through the driver in every batch
        by_key = out_keys.hint("merge")
        if partition_col in keys:
            old = out_keys.select(partition_col)    # a key says where it is: the table is not searched for it
        else:
            old = table.join(by_key, [table[k].eqNullSafe(out_keys[k]) for k in keys], "left_semi").select(partition_col)
        parts = new.select(partition_col).union(old).distinct().withColumnRenamed(partition_col, "_part")
        parts.write.parquet(f"{root}/parts")
        # the partitions that are touched are folders of the table: as literals they limit what is read of it
        values = [r[0] for r in spark.read.schema(parts.schema).parquet(f"{root}/parts").collect()]
        touched = table.where(F.col(partition_col).isin([v for v in values if v is not None])
                              | (F.col(partition_col).isNull() & F.lit(None in values)))
        merged = touched.join(by_key, [touched[k].eqNullSafe(out_keys[k]) for k in keys], "left_anti")
        # written once, as the folders that are swapped in; a partition that all rows have left has none
        merged.unionByName(new).write.partitionBy(partition_col).parquet(f"{root}/merged")
        left = spark.read.schema(f"_part {dict(new.dtypes)[partition_col]}").parquet(f"{root}/parts")
        there = {partition_folder(spark, partition_col, r[0]) for r in left.select(F.col("_part").cast("string")).collect()}
        _swap_folders(spark, f"{root}/merged", table_path.rstrip("/"), there, f"{root}/was")
    finally:
        _delete(spark, root)
