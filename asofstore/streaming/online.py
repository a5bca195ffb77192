"""Online features: the last rounds of every driver, kept as keyed state while sessions land.

State per driver: its sessions of its newest ``rounds`` rounds, and those of its last date. A round among
the newest N of all rounds is among the newest N of each driver that took part in it, so this bounded state
answers every window of up to ``rounds`` rounds at the newest date, whatever the order of arrival: a late
session takes its place by season and round, and a session that comes again replaces its earlier form.

Drivers are kept in ``GROUPS`` groups by hash, one state each: a call of the state function costs more than a
driver's merge, so many drivers share one.

Each micro-batch puts the kept sessions of the drivers that changed in the place of what the online table had
for them. :func:`online_features` reads that table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..schema import SESSION_RESULTS
from ..sources.tables import normalize_results
from ..sources.upsert import replace_rows
from .ingest import landed_stream

KEPT = "driverid string, year int, roundnumber int, mode string, at long, position double, gridposition double, points double, status string"
_KEY = ["year", "roundnumber", "mode"]
_REST = ["at", "position", "gridposition", "points", "status"]
_TYPES = {"year": "int32", "roundnumber": "int32", "at": "int64", "position": float, "gridposition": float, "points": float}
BUCKETS = 64
GROUPS = 1 << 16


def _newest(rows: dict[tuple, list], rounds: int) -> dict[tuple, list]:
    """The sessions of the newest ``rounds`` rounds and of the last date."""
    keep = set(sorted({k[:2] for k in rows}, reverse=True)[:rounds])
    day = max(r[0] for r in rows.values()) // 86_400_000_000
    return {k: r for k, r in rows.items() if k[:2] in keep or r[0] // 86_400_000_000 == day}


def _plain(v):
    return None if v is None or v != v else v


def keep_rounds(rounds: int):
    """State function: merge the landed sessions of a group of drivers into their kept ones, each driver by itself.
    The drivers that sessions landed for come out."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = {d: {tuple(k): r for k, r in rows} for d, rows in json.loads(state.get[0]).items()} if state.exists else {}
        landed: dict[str, list] = {}
        changed, waiting = set(), 0

        def merge():
            for d, new in landed.items():
                kept[d] = _merged(kept.get(d, {}), new, rounds)
            changed.update(landed)
            landed.clear()

        for f in frames:
            columns = [f[c].tolist() for c in (*_KEY, *_REST)]
            for d, *row in zip(f["driverid"].tolist(), f["_at"].tolist(), f["_file"].tolist(), zip(*columns)):
                landed.setdefault(d, []).append(row)
            waiting += len(f)
            if waiting > 10_000:    # drivers with many landed rows stay bounded
                merge()
                waiting = 0
        merge()
        state.update((json.dumps({d: [[list(k), r] for k, r in sorted(rows.items())] for d, rows in kept.items()}),))
        columns = zip(["driverid", *_KEY, *_REST], zip(*[(d, *k, *r) for d in sorted(changed) for k, r in kept[d].items()]))
        yield pd.DataFrame({c: np.array(v, _TYPES.get(c, object)) for c, v in columns}, copy=False)
    return run


def _merged(rows: dict[tuple, list], landed: list, rounds: int) -> dict[tuple, list]:
    for _, _, r in sorted(landed, key=lambda x: (x[0], x[1])):
        rows[int(r[0]), int(r[1]), r[2]] = [int(r[3]), *map(_plain, r[4:])]
    return _newest(rows, rounds) if rows else rows


def follow(spark: SparkSession, landing: str, table: str, checkpoint: str, rounds: int = 40,
           max_files_per_trigger: int = 1) -> None:
    """Drain a landing folder into the online table. Rows without a key or a date have no place in it."""
    landed = landed_stream(spark, landing, max_files_per_trigger)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ("driverid", *_KEY, "date"))
    rows = normalize_results(landed).where(whole).select(
        "driverid", *_KEY, F.unix_micros("date").alias("at"), *_REST[1:], "_file", F.unix_micros("_at").alias("_at"))
    rows = rows.withColumn("_group", F.pmod(F.xxhash64("driverid"), F.lit(GROUPS)))
    kept = rows.groupBy("_group").applyInPandasWithState(keep_rounds(rounds), KEPT, "rows string", "update", "NoTimeout")

    def put(batch: DataFrame, batch_id: int) -> None:
        now = batch.withColumn("bucket", F.pmod(F.xxhash64("driverid"), F.lit(BUCKETS)).cast("int"))
        replace_rows(batch.sparkSession, table, now, now, ["driverid"], "bucket")

    q = (kept.writeStream.outputMode("update").foreachBatch(put)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def online_features(spark: SparkSession, table: str, year_start: int, year_stop: int, last_rounds: int = 10) -> DataFrame:
    """The features of every eligible driver at the newest date, from the online table alone."""
    kept = spark.read.parquet(table).drop("bucket").withColumn("date", F.timestamp_micros("at"))
    rows = kept.select(*[F.col(f.name) if f.name in kept.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in SESSION_RESULTS])
    last = rows.where(F.col("year").between(year_start, year_stop)).agg(F.max(F.to_date("date")).alias("dt_ref"))
    probes = rows.select("driverid").distinct().join(F.broadcast(last), F.lit(True))
    return FE.window_features(rows, year_start, year_stop, last_rounds, probes=probes)
