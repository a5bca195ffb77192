"""Season labels and the analytical base table (ABT)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import RACE, SPRINT


def season_points(results: DataFrame, modes=(RACE, SPRINT),
                  exclude_year: int | None = None) -> DataFrame:
    """``(year, driverid, totalpoints)``: points per driver and season.

    The running season is left out (its title is not decided);
    ``exclude_year`` defaults to the current year and can be fixed for
    reproducible runs. Partial sums are combined map-side.
    """
    excl = F.year(F.current_date()) if exclude_year is None else F.lit(exclude_year)
    return (results.where(F.col("mode").isin(*modes) & (F.col("year") != excl))
            .groupBy(F.col("year").cast("int").alias("year"), "driverid")
            .agg(F.sum("points").alias("totalpoints")))


def season_champions(results: DataFrame, modes=(RACE, SPRINT),
                     exclude_year: int | None = None) -> DataFrame:
    """``(year, driverid, totalpoints, rankdriver)`` for the top driver of each season.

    Ties on points go to the smallest driverid, so the label is
    deterministic. ``row_number() ... = 1`` is planned with a partial
    per-task top-1 (WindowGroupLimit) before the shuffle, so a season's
    partition carries one candidate per map task, not every driver.
    """
    pts = season_points(results, modes, exclude_year)
    w = Window.partitionBy("year").orderBy(F.col("totalpoints").desc(), F.col("driverid"))
    return (pts.withColumn("rankdriver", F.row_number().over(w))
            .where(F.col("rankdriver") == 1))


def abt(features: DataFrame, champions: DataFrame, start: str | dt.date,
        stop: str | dt.date) -> DataFrame:
    """Feature rows in ``[start, stop)`` with ``flchampion`` 0/1.

    The label joins on the calendar year of ``dt_ref``: a season's rows are
    labelled with that season's champion. The champions are one row per season, so
    they are broadcast and feature rows are not exchanged.
    """
    lab = champions.select(F.col("year").alias("_y"), F.col("driverid").alias("_d"), "rankdriver")
    f = features.where((F.col("dt_ref") >= F.lit(start).cast("date"))
                       & (F.col("dt_ref") < F.lit(stop).cast("date")))
    j = f.join(F.broadcast(lab), (F.col("driverid") == F.col("_d")) & (F.year("dt_ref") == F.col("_y")), "left")
    return j.select(*features.columns,
                    F.coalesce(F.col("rankdriver"), F.lit(0)).cast("int").alias("flchampion"))
