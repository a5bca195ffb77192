"""Leakage-aware sampling: out-of-time split, season-tail trim, grouped stratified split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_year(df: DataFrame) -> DataFrame:
    """Add ``year`` = calendar year of ``dt_ref`` (F2)."""
    return df.withColumn("year", F.year("dt_ref").cast("int"))


def oot_split(abt: DataFrame, oot_year: int) -> tuple[DataFrame, DataFrame]:
    """``(analytics, oot)``: seasons before ``oot_year`` and the ``oot_year`` season (M1, P10)."""
    df = abt if "year" in abt.columns else with_year(abt)
    return df.where(F.col("year") < oot_year), df.where(F.col("year") == oot_year)


def season_dates(analytics: DataFrame) -> DataFrame:
    """Distinct ``(year, dt_ref)``."""
    return analytics.select("year", "dt_ref").distinct()


def season_tail_trim(analytics: DataFrame, drop_latest: int = 6) -> DataFrame:
    """``(year, dt_ref)`` without the ``drop_latest`` newest dates of each season.

    The window is per season over distinct dates only (at most 366 rows).
    """
    w = Window.partitionBy("year").orderBy(F.col("dt_ref").desc())
    d = season_dates(analytics).withColumn("rk", F.row_number().over(w) - 1)
    return d.where(F.col("rk") >= drop_latest).drop("rk")


def driver_year_labels(analytics: DataFrame) -> DataFrame:
    """Distinct ``(driverid, year, flchampion)``: the sampling unit."""
    return analytics.select("driverid", "year", "flchampion").distinct()


def _hash_key(seed: int):
    return F.md5(F.concat_ws("|", F.col("driverid"), F.col("year").cast("string"), F.lit(str(seed))))


def stratified_split(units: DataFrame, train_frac: float = 0.8, seed: int = 42,
                     label: str = "flchampion", buckets_hex: int = 3) -> DataFrame:
    """Add ``split`` ('train'/'test'): per label, the first ``floor(train_frac * n)``
    units in seeded md5 order go to train (M3).

    Exact and distributed: units are bucketed by the leading hex digits of the
    hash (order preserving, ``16**buckets_hex`` buckets); bucket sizes give each
    bucket's offset with a window over at most ``16**buckets_hex`` rows per
    label; the final rank is taken inside a bucket. No task holds more than
    one bucket of one label.
    """
    u = units.withColumn("_h", _hash_key(seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, buckets_hex), 16, 10).cast("int"))
    sizes = u.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_m"))
    wl = Window.partitionBy(label)
    sizes = (sizes
             .withColumn("_off", F.coalesce(F.sum("_m").over(
                 wl.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_k", F.floor(F.lit(train_frac) * F.sum("_m").over(wl))))
    # one row per (label, bucket); AQE broadcasts it by its measured size
    sizes = sizes.select(label, "_b", "_off", "_k")
    j = u.join(sizes, [label, "_b"])
    pos = F.col("_off") + F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h"))
    return (j.withColumn("split", F.when(pos <= F.col("_k"), "train").otherwise("test"))
            .drop("_h", "_b", "_off", "_k"))


def split_sets(split_units: DataFrame, analytics: DataFrame,
               trimmed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: rows of the chosen (driver, season) units on kept dates.

    ``trimmed`` has at most 366 rows per season and is broadcast.
    """
    base = (analytics.join(split_units, ["driverid", "year", "flchampion"])
            .join(F.broadcast(trimmed), ["year", "dt_ref"]))
    return (base.where(F.col("split") == "train").drop("split"),
            base.where(F.col("split") == "test").drop("split"))
