"""Incremental ingestion with Structured Streaming.

A landing folder receives one Parquet file per session; a file-source stream
picks up new files only (its checkpoint remembers what was read), and each
micro-batch is merged into the bronze table keyed by
(driverid, year, roundnumber, mode). Re-running is idempotent: processed files
are skipped and a replayed batch upserts the same keys. Scheduling is the
caller's (``trigger(availableNow=True)`` drains what is there and stops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import SESSION_RESULTS
from ..session import remove_path, scratch_dir
from ..sources.tables import normalize_results
from ..sources.upsert import upsert

BRONZE_KEYS = ["driverid", "year", "roundnumber", "mode"]


LEDGER = "path string, batch bigint, n_rows bigint, n_bad bigint, ok boolean"


def newest_rows(batch: DataFrame) -> DataFrame:
    """One row per session key of a batch: a session and its correction may land together, the newest file wins."""
    rows = normalize_results(batch)
    cols = [f.name for f in SESSION_RESULTS if f.name not in BRONZE_KEYS]
    newest = F.max(F.struct("_at", "_file", F.struct(*cols).alias("row"))).alias("_n")
    rows = rows.groupBy(*BRONZE_KEYS).agg(newest).select(*BRONZE_KEYS, "_n.row.*")
    return rows.select(*SESSION_RESULTS.names)


def landed_stream(spark: SparkSession, landing: str, max_files_per_trigger: int = 1, archive_dir: str | None = None) -> DataFrame:
    """New session files of a landing folder, with the file (``_file``, ``_path``) and its time (``_at``) per row."""
    reader = (spark.readStream.schema(SESSION_RESULTS)
              .option("pathGlobFilter", "*.parquet")
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir == "":
        reader = reader.option("cleanSource", "delete")
    elif archive_dir:
        # move a landed file away only after its batch committed
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.parquet(landing).select("*", F.col("_metadata.file_modification_time").alias("_at"),
                                          F.col("_metadata.file_name").alias("_file"),
                                          F.col("_metadata.file_path").alias("_path"))


def drain(stream: DataFrame, merge, checkpoint: str) -> None:
    """Run ``merge(batch, batch_id)`` on all that is there, and stop."""
    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_landing(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                   max_files_per_trigger: int = 1, archive_dir: str | None = None) -> None:
    """Drain ``landing`` into ``bronze`` (Parquet partitioned by ``year``).

    ``archive_dir``: where to move files whose batch is in; ``""`` deletes them.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, bronze, newest_rows(batch), BRONZE_KEYS, "year")

    drain(landed_stream(spark, landing, max_files_per_trigger, archive_dir), merge, checkpoint)


# ---------------------------------------------------------------- file ledger

def ingest_with_ledger(spark: SparkSession, landing: str, bronze: str, ledger: str, checkpoint: str,
                       max_files_per_trigger: int = 1, clean: bool = True) -> None:
    """Drain ``landing`` into ``bronze`` with a ledger row per file (``LEDGER``), and delete the files that are in.

    A file with a row that has no key is not ok: none of its rows is merged and the file stays. The ledger of a
    batch is written after its rows, over whatever an earlier try of the batch wrote; files are deleted last, and
    only by what the ledger says, so a run that stops in between is finished by the next.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bad = F.coalesce(*[F.when(F.col(k).isNull(), True) for k in BRONZE_KEYS], F.lit(False))
        path = scratch_dir(spark, "landed")
        batch.withColumn("_bad", bad).write.parquet(path)
        rows = spark.read.parquet(path)
        files = rows.groupBy(F.col("_path").alias("path")).agg(
            F.lit(batch_id).cast("bigint").alias("batch"), F.count("*").alias("n_rows"), F.count_if("_bad").alias("n_bad"))
        files = files.withColumn("ok", F.col("n_bad") == 0)
        refused = files.where("NOT ok").select(F.col("path").alias("_path"))
        good = rows.join(refused, "_path", "left_anti").drop("_bad")
        upsert(spark, bronze, newest_rows(good), BRONZE_KEYS, "year")
        files.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/in_batch={batch_id}")
        remove_path(spark, path)

    drain(landed_stream(spark, landing, max_files_per_trigger), merge, checkpoint)
    if clean:
        delete_landed(spark, landing, ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def delete_landed(spark: SparkSession, landing: str, ledger: str) -> int:
    """Delete the landed files that the ledger has as ok and that are still there; how many they were."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    ok = read_ledger(spark, ledger).where("ok").select(F.col("path"))
    there = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(landing)
             .select(F.col("path"), F.regexp_replace("path", "^file:/+", "file:/").alias("_same")))
    same = ok.select(F.regexp_replace("path", "^file:/+", "file:/").alias("_same")).distinct()
    n = 0
    for r in there.join(same, "_same", "left_semi").select("path").toLocalIterator():
        file = hadoop.Path(r["path"])
        n += file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
    return n


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Scoring is a stateless map: a fitted PipelineModel of either kind applies
    to a stream as is (M12)."""
    from ..operators.ml import probability_of_win
    return probability_of_win(model.transform(stream))
