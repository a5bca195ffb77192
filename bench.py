"""Benchmark of the headline queries; prints one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_LITERAL  number of alternating runs against the literal form of the
                   definitions (default 0: none); adds ``literal`` to the output

The session relation is derived from lineitem/supplier/nation once and written
as a bronze Parquet table (its time is reported as ``session_results``); the
feature, label and metric queries then read the bronze table, as a deployment
reads its landed table. Session settings are the library's own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from asofstore.operators import asof, labels, metrics, split  # noqa: E402
from asofstore.operators import features as FE  # noqa: E402
from asofstore.plans import catalog as C  # noqa: E402
from asofstore.session import local_session, scratch_dir  # noqa: E402
from asofstore.sources.tables import session_results  # noqa: E402


def run_all(df) -> float:
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return round(time.time() - t, 3)


def literal(res, ys: int, ye: int, n: int | None, suffix: str = ""):
    aggs = [F.countDistinct("year").alias(f"qtd_seasons{suffix}")]
    for name, kind, sql, mode in FE.feature_specs()[1:]:
        value = F.expr(f"CASE WHEN {sql} THEN 1 ELSE 0 END" if kind == "count" else sql)
        value = value if mode is None else F.when(F.col("mode") == mode, value)
        aggs.append((F.avg(value) if kind == "avg" else F.sum(value)).alias(f"{name}{suffix}"))
    known = res.withColumn("d", F.to_date("date"))
    seen = known.join(asof.dim_dates(res, ys, ye), F.col("d") <= F.col("dt_ref"))
    if n is not None:
        newest = Window.partitionBy("dt_ref").orderBy(F.desc("year"), F.desc("roundnumber"))
        inside = seen.select("dt_ref", "year", "roundnumber").distinct().withColumn("place", F.row_number().over(newest))
        seen = seen.join(inside.where(F.col("place") <= n).drop("place"), ["dt_ref", "year", "roundnumber"])
    eligible = known.join(asof.dim_dates(res, ys, ye), F.col("d") <= F.col("dt_ref")).where("ref_year - year <= 2")
    return seen.join(eligible.select(*FE.KEYS).distinct(), FE.KEYS).groupBy(*FE.KEYS).agg(*aggs)


def literal_all(res, ys: int, ye: int):
    out = None
    for w, n in FE.WINDOWS.items():
        part = literal(res, ys, ye, n, f"_{w}")
        out = part if out is None else out.join(part, FE.KEYS)
    about = res.select(F.to_date("date").alias("dt_ref"), "driverid", *FE.ATTRIBUTES)
    return out.join(about, FE.KEYS, "left")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus, app_name="asofstore-bench")
    ys, ye = C.YEAR_START, C.YEAR_STOP
    times: dict[str, float] = {}

    def timed(name, build):
        times[name] = run_all(build())

    bronze = scratch_dir(spark, "bench-bronze")
    t = time.time()
    session_results(spark, sf_dir).write.mode("overwrite").partitionBy("year").parquet(bronze)
    times["session_results"] = round(time.time() - t, 3)
    # cached as in the baseline's prototype runs; a lost cache block is
    # re-read from the written bronze table, not recomputed from lineitem
    res = spark.read.parquet(bronze).cache()
    res.count()

    timed("eligible_drivers", lambda: asof.eligible_drivers(res, ys, ye))
    timed("driver_features_last_10", lambda: FE.window_features(res, ys, ye, 10))
    timed("driver_features_life", lambda: FE.window_features(res, ys, ye, None))
    timed("driver_features_all", lambda: FE.consolidated_features(res, ys, ye))
    timed("season_champions", lambda: labels.season_champions(res))

    store = scratch_dir(spark, "bench-store")
    FE.consolidated_features(res, ys, ye).write.mode("overwrite").parquet(store)
    fs = spark.read.parquet(store)
    timed("abt", lambda: labels.abt(fs, labels.season_champions(res), C.ABT_START, C.ABT_STOP))

    def scored():
        a = labels.abt(fs, labels.season_champions(res), C.ABT_START, C.ABT_STOP)
        analytics, oot = split.oot_split(a, C.OOT_YEAR)
        trimmed = split.season_tail_trim(analytics, C.DROP_LATEST)
        units = split.stratified_split(split.driver_year_labels(analytics), C.TRAIN_FRAC, C.SEED)
        train, test = split.split_sets(units, analytics, trimmed)
        parts = [train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test")),
                 oot.withColumn("split", F.lit("oot"))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("score", C.surrogate_score())

    timed("auc_by_split", lambda: metrics.auc_by_split(scored()))
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}

    runs = int(os.environ.get("BENCH_LITERAL", "0"))
    if runs:
        forms = {"last_10": (lambda a, b: FE.window_features(res, a, b, 10), lambda a, b: literal(res, a, b, 10)),
                 "all": (lambda a, b: FE.consolidated_features(res, a, b), lambda a, b: literal_all(res, a, b))}
        out["literal"] = {}
        for years in ((1998, 1999), (ys, ye)):
            for name, (ours, plain) in forms.items():
                key = f"{name} {years[0]}-{years[1]}"
                out["literal"][key] = got = {"ours": [], "literal": []}
                for k in range(runs):
                    for form, build in (("ours", ours), ("literal", plain))[:: 1 if k % 2 else -1]:
                        got[form].append(run_all(build(*years)))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
