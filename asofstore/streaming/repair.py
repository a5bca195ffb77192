"""Keeping the feature store right while sessions land.

A batch of sessions changes more rows of the store than its own: a session changes its
driver's rows from its date on, and a round that appears (or begins on another day)
moves every finite window of all drivers from then on. Which rows these are follows from
the calendar before and after the batch:

* rows of a driver in the batch, at dates on or after its first changed session (as it was
  or as it is now);
* all rows at dates whose window bounds or reference seasons differ between the two
  calendars, which includes dates that are new or gone.

These rows alone are made again and put in the place of what the store had for them. The
calendar before and the changed drivers are written to a pending folder before the
sessions are merged, so a batch that is tried again after it stopped half way finds the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof
from ..operators import features as FE
from ..operators import windows as WN
from ..schema import KEYS, SESSION_RESULTS, WINDOWS
from ..session import remove_path
from ..sources.upsert import _exists, _has_rows, replace_rows, upsert
from .ingest import BRONZE_KEYS, drain, landed_stream, newest_rows

LOG = "batch bigint, n_sessions bigint, n_dates bigint, n_pairs bigint, n_rows bigint"


def calendar(results: DataFrame, year_start: int, year_stop: int, windows: dict) -> DataFrame:
    """Per reference date the bounds of the finite windows and the reference seasons: what the rows of all
    drivers at that date depend on, besides the driver's own sessions."""
    bounds = WN.window_bounds(results, year_start, year_stop, windows)
    seasons = (asof.dim_dates(results, year_start, year_stop).groupBy("dt_ref")
               .agg(F.array_join(F.sort_array(F.collect_set("ref_year")), ",").alias("seasons")))
    columns = [c for c in bounds.columns if c != "dt_ref"]
    return seasons.join(bounds, "dt_ref", "left").select("dt_ref", F.concat_ws("|", "seasons", *[
        F.col(c).cast("string") for c in columns]).alias("mark"))


def affected(before: DataFrame, after: DataFrame, drivers: DataFrame, results: DataFrame, store: DataFrame | None,
             year_start: int, year_stop: int) -> tuple[DataFrame, DataFrame]:
    """(dates at which all rows change, (dt_ref, driverid) pairs that may change).

    Pairs are those that are eligible now or in the store; ``drivers`` has each changed driver's first date.
    """
    old, new = before.withColumnRenamed("mark", "_old"), after.withColumnRenamed("mark", "_new")
    dates = old.join(new, "dt_ref", "full").where("NOT _old <=> _new").select("dt_ref")
    pairs = asof.eligible_drivers(results, year_start, year_stop)
    if store is not None:
        pairs = pairs.unionByName(store.select(*KEYS)).distinct()
    of_drivers = pairs.join(asof.by_exchange(drivers), "driverid").where("dt_ref >= first_d").select(*KEYS)
    return dates, of_drivers.unionByName(pairs.join(dates, "dt_ref", "left_semi").select(*KEYS)).distinct()


class StoreRepair:
    """Bronze sessions and the consolidated store beside them, kept in step batch by batch.

    ``root`` holds ``bronze`` (by season), ``store`` (by year of ``dt_ref``), ``pending`` and ``log``.
    """

    def __init__(self, spark: SparkSession, root: str, year_start: int, year_stop: int, windows: dict | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.years, self.windows = (year_start, year_stop), dict(WINDOWS if windows is None else windows)
        self.bronze, self.store, self.log = f"{self.root}/bronze", f"{self.root}/store", f"{self.root}/log"

    def _results(self) -> DataFrame:
        if not _has_rows(self.spark, self.bronze):
            return self.spark.createDataFrame([], SESSION_RESULTS)
        return self.spark.read.schema(SESSION_RESULTS).parquet(self.bronze)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.store).drop("dt_year")

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Merge a batch (``SESSION_RESULTS``, unique session keys) and repair the store."""
        pending = f"{self.root}/pending/{batch_id}"
        finite = {f"_{w}": n for w, n in self.windows.items()}
        if not _exists(self.spark, f"{pending}/done"):
            now = self._written(rows, f"{pending}/rows")
            was = self._results()
            self._written(calendar(was, *self.years, finite), f"{pending}/before")
            both = now.unionByName(was.join(asof.by_exchange(now.select(*BRONZE_KEYS)), BRONZE_KEYS, "left_semi"))
            firsts = asof.with_session_date(both).where("driverid IS NOT NULL").groupBy("driverid").agg(F.min("d").alias("first_d"))
            self._written(firsts, f"{pending}/drivers")
            self.spark.range(1).write.mode("overwrite").parquet(f"{pending}/done")
        read = lambda name: self.spark.read.parquet(f"{pending}/{name}")
        now = self.spark.read.schema(rows.schema).parquet(f"{pending}/rows")
        upsert(self.spark, self.bronze, now, BRONZE_KEYS, "year")
        results = self._results()
        store = self.spark.read.parquet(self.store) if _has_rows(self.spark, self.store) else None
        after = self._written(calendar(results, *self.years, finite), f"{pending}/after")
        dates, pairs = affected(read("before"), after, read("drivers"), results, store, *self.years)
        pairs = self._written(pairs, f"{pending}/pairs")
        redone = FE.consolidated_features(results, *self.years, windows=self.windows, probes=pairs)
        # written once, by the swap; the rows that the store then has for the pairs are those that were made again
        replace_rows(self.spark, self.store, redone.withColumn("dt_year", F.year("dt_ref")), pairs, KEYS, "dt_year")
        made = 0
        if _has_rows(self.spark, self.store):
            made = self.read().select(*KEYS).join(asof.by_exchange(pairs), KEYS, "left_semi").count()
        facts = [(batch_id, now.count(), dates.count(), pairs.count(), made)]
        self.spark.createDataFrame(facts, LOG).write.mode("overwrite").parquet(f"{self.log}/in_batch={batch_id}")
        remove_path(self.spark, pending)

    def ingest(self, landing: str, checkpoint: str, max_files_per_trigger: int = 1) -> None:
        """Drain a landing folder into bronze and the store."""
        drain(landed_stream(self.spark, landing, max_files_per_trigger),
              lambda batch, batch_id: self.merge(newest_rows(batch), batch_id), checkpoint)
