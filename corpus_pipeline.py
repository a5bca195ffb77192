"""Corpus pipeline: documents to packed training sequences.

Each stage takes all that its predecessor kept, reread from Parquet, and its
decisions take effect:

1. language ID: documents without a language (``und``) go; a missing ``lang``
   is filled in;
2. MinHash near-dedup (five-word shingles, similarity 0.8): the first document
   of each group stays;
3. substring dedup: repeats of 50 words or more are cut from all but the first
   document that has them; a document that was nothing but repeats goes;
4. benchmark decontamination: documents that contain a benchmark item, also
   with other numbers, names or units, go;
5. packing: what is left becomes pieces of 4096-token sequences with their ids.

All but the last return the columns of ``documents``. No stage can be written
as SQL over the tables (a trained model, similarity search and a tokenizer), so
there is no ORACLE_SQL; tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofstore.llm import common, decontaminate, language, minhash, packing, substring
from asofstore.llm.queries import WORD_TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs, language.fit(docs, F.lit(True))).where("lang_pred != 'und'")
    return found.select(*[F.coalesce("lang", "lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(docs, window=50).where("text != ''")
    return cut.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_TOKENIZER, end_id=2, tokens=4096, with_ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
