"""Table scans of the given parquet tables and the session-results relation.

``session_results`` derives one row per driver per session from ``lineitem``,
``supplier`` and ``nation`` (the rule is written down in FIXTURES.md and is the
same text the DuckDB oracle runs). Everything downstream only sees the bronze
schema of :mod:`asofstore.schema`, so a real landed results table can be used
in its place through :func:`normalize_results`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SESSION_RESULTS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one given table; projection and filters push into the parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def normalize_results(df: DataFrame) -> DataFrame:
    """Cast a landed results frame to the bronze schema.

    NaN in the numeric measures becomes NULL: in Spark NaN compares greater
    than every number and poisons averages, while the feature definitions
    treat a missing position as "no value".
    """
    out = []
    for f in SESSION_RESULTS.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in ("position", "gridposition", "points"):
            c = F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
        out.append(c.alias(f.name))
    extra = [c for c in df.columns if c.lower() not in {f.name for f in SESSION_RESULTS.fields}]
    return df.select(*out, *extra)


def session_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session results relation derived from the given TPC-H style tables.

    Every line item counts. A session result is what one driver's line items of
    one ship month and return flag add up to: ship year = season, ship month =
    round, return flag = session type. A supplier is a seat that three-season
    careers hold one after the other, so drivers come and go. All measures are
    sums or extremes, combined before the shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem")
    totals = (li.groupBy(
                  "l_suppkey",
                  F.year("l_shipdate").cast("int").alias("yr"),
                  F.month("l_shipdate").cast("int").alias("rnd"),
                  F.when(F.col("l_returnflag") == "A", "Race")
                   .when(F.col("l_returnflag") == "R", "Sprint")
                   .otherwise("Other").alias("md"))
              .agg(F.sum("l_orderkey").alias("ok"), F.sum("l_linenumber").alias("ln"),
                   F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("dc"),
                   F.max("l_discount").alias("dmax"),
                   # whether the least status is F, as flags: with a string's minimum Spark sorts all line items
                   F.bool_or(F.col("l_linestatus") == "F").alias("has_f"), F.bool_or(F.col("l_linestatus") < "F").alias("has_less")))

    ok, ln = F.col("ok"), F.col("ln")
    mon = (F.when((F.col("yr") % 2 == 0) & F.col("rnd").isin(5, 7), 12 - F.col("rnd"))
           .otherwise(F.col("rnd")))
    pos = totals.select(
        "*", F.nullif((ok * 3 + ln * 5) % 22, F.lit(0)).alias("p"), F.nullif((ok * 7 + ln) % 23, F.lit(22)).alias("g"),
        mon.alias("mon"), F.floor((F.col("yr") + F.col("l_suppkey")) / 3).cast("long").alias("era"))

    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation has 25 rows by definition: a fixed size bound, safe to broadcast.
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    joined = (pos.join(supplier, pos.l_suppkey == supplier.s_suppkey)
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))

    md5 = F.upper(F.substring(F.md5(F.col("n_name")), 1, 6))
    full = F.concat("s_name", F.lit(" "), F.col("era").cast("string"))
    return joined.select(
        F.concat(F.lit("d"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("era").cast("string"))
         .alias("driverid"),
        F.col("yr").alias("year"),
        F.col("rnd").alias("roundnumber"),
        F.col("md").alias("mode"),
        F.make_date("yr", "mon", F.when(F.col("md") == "Sprint", 14).otherwise(28))
         .cast("timestamp").alias("date"),
        F.col("p").cast("double").alias("position"),
        F.col("g").cast("double").alias("gridposition"),
        F.when(F.col("p") <= 10, F.col("dc") / F.lit(4.0)).otherwise(F.lit(0.0)).alias("points"),
        F.when(F.col("p").isNull(), "Retired")
         .when(F.col("has_f") & ~F.coalesce("has_less", F.lit(False)), "Finished")
         .when(F.col("dmax") > 0.05, "+1 Lap")
         .otherwise("Lapped").alias("status"),
        F.when(F.col("rnd") % 5 == 0, F.upper(full)).otherwise(full).alias("fullname"),
        F.col("n_name").alias("teamname"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit(None).cast("string"))
         .when(F.col("l_suppkey") % 4 == 1, F.lit(""))
         .when(F.col("l_suppkey") % 4 == 2, md5)
         .otherwise(F.concat(F.lit("#"), md5)).alias("teamcolor"),
    )
