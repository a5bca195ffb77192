"""Ingestion bookkeeping as set operations: session grid, missing sessions, context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import file_name, session_file
from ..schema import RACE, SPRINT

# Highest round tried per season, and session types tried in order.
MAX_ROUNDS = 29
MODES = (RACE, SPRINT)


def session_grid(seasons: DataFrame, max_rounds: int = MAX_ROUNDS, modes=MODES,
                 years: tuple[int, int] | None = None, ahead: int | None = None) -> DataFrame:
    """``(year, roundnumber, mode)`` candidates: seasons x rounds 1..max x modes.

    The seasons are those of ``seasons``; with ``ahead`` every season from its first to
    ``ahead`` after its last; with ``years`` an inclusive range, whatever has landed.
    Generated with ``explode`` per season row -- no cross join.
    """
    year = F.col("year").cast("int")
    if years is not None:
        base = seasons.sparkSession.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("year"))
    elif ahead is not None:
        span = seasons.agg(F.min(year).alias("low"), F.max(year).alias("high")).where("low IS NOT NULL")
        base = span.select(F.explode(F.sequence("low", F.col("high") + ahead)).alias("year"))
    else:
        base = seasons.select(year.alias("year")).distinct()
    return (base.withColumn("roundnumber", F.explode(F.sequence(F.lit(1), F.lit(max_rounds))))
            .withColumn("mode", F.explode(F.array(*[F.lit(m) for m in modes]))))


def missing_sessions(grid: DataFrame, landed: DataFrame) -> DataFrame:
    """Candidate sessions that were tried and found empty.

    A round's later session types are only tried when its race landed, so a
    sprint counts as missing only in a round whose race exists.
    """
    have = landed.select("year", "roundnumber", "mode").distinct()
    races = have.where(F.col("mode") == RACE).select("year", "roundnumber")
    tried = (grid.where(F.col("mode") == MODES[0])
             .unionByName(grid.where(F.col("mode") != MODES[0])
                          .join(races, ["year", "roundnumber"], "left_semi")))
    return tried.join(have, ["year", "roundnumber", "mode"], "left_anti")


def enrich_sessions(results: DataFrame, events: DataFrame) -> DataFrame:
    """Attach session context (event name, country, location) to driver rows."""
    return results.join(events, ["year", "roundnumber"], "left")


def session_files(landed: DataFrame, raw_dir: str = "data/raw",
                  bucket_folder: str = "landed") -> DataFrame:
    """Per landed session: its file name ``{year}_{round:02}_{code}.parquet``,
    the local path and the object-store key built from the file name (F12)."""
    s = landed.select("year", "roundnumber", "mode").distinct()
    name = session_file(F.col("year"), F.col("roundnumber"), F.substring("mode", 1, 1))
    path = F.concat(F.lit(raw_dir.rstrip("/") + "/"), name)
    return (s.withColumn("path", path)
            .withColumn("file", file_name(F.col("path")))
            .withColumn("bucket_path", F.concat(F.lit(bucket_folder.rstrip("/") + "/"), F.col("file"))))
