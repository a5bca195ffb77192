"""Delta-maintained token count rollups (operator 7).

The rollup holds additive totals (documents, tokens) by source, language and
tokenizer version. It changes only by **batches** of signed rows: an insert is
+1 document and +tokens, a delete is the same with minus, a revised count is
the old row with minus and the new one with plus. A batch is aggregated with
map-side combining (a source that holds a third of all rows is a few partial
rows per task) and written as one small delta under its batch id.

**Idempotent commits.** A batch counts when its folder has the writer's success
mark; committing an id again does nothing, and a commit that broke off leaves
no mark and is overwritten by the next attempt. Totals are the sum of all
committed deltas. ``compact`` folds deltas into one base that names the ids it
contains, so an id that is folded still counts as committed.

Defined results: null text has no tokens but is a document; null source or lang
is a group of its own; groups without documents and tokens are left out of the
totals; repeated rows count each; an empty batch is a committed batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
# The split rule of the byte-level vocabularies, for text of
# printable ASCII and Latin letters (other text goes to the tokenizer whole).
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ž", "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ž]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\\s{_L}{_N}]+|\\s+(?!\\S)|\\s+")


class PieceCounts(C.Remembered):
    """Number of tokens of each pre-token."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def make(self, piece: str) -> int:
        return len(self.coder.encode_ordinary(piece))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if _PLAIN.fullmatch(text):
            return sum(map(self.__getitem__, _PIECES.findall(text)))
        return len(self.coder.encode_ordinary(text))


_COUNTERS: dict[str, PieceCounts] = {}


def _counter(path: str, pattern: str) -> PieceCounts:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounts(path, pattern)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabularies: dict[str, str], pattern: str, only: dict[str, Callable] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, source, lang, _k1, _k2, one count per tokenizer version). ``only``
    limits a version to the languages it is for (the count is null elsewhere)."""
    C.small_batches(docs.sparkSession)
    only = only or {}
    names = list(vocabularies)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col("source").cast("string").alias("source"),
                      F.col("lang").cast("string").alias("lang"), F.col(text_col).alias("_text"))

    def run(batches):
        for b in C.slices(batches, 500):
            texts, langs = b.column("_text").to_pylist(), b.column("lang").to_pylist()
            key = [xxhash.xxh3_128_intdigest((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            counts = []
            for n in names:
                c, wanted = _counter(vocabularies[n], pattern), only.get(n)
                counts.append(pa.array([c.count(t) if wanted is None or wanted(l) else None
                                        for t, l in zip(texts, langs)], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("source"), b.column("lang"),
                 C.long_array(np.array([k >> 64 for k in key], np.uint64)),
                 C.long_array(np.array([k & 0xFFFFFFFFFFFFFFFF for k in key], np.uint64)), *counts],
                names=["_id", "source", "lang", "_k1", "_k2", *names])
    return src.mapInArrow(run, "_id bigint, source string, lang string, _k1 bigint, _k2 bigint, "
                          + ", ".join(f"`{n}` bigint" for n in names))


def signed(rows: DataFrame, tokenizer: str, sign: int) -> DataFrame:
    """Signed change rows from a ledger that has a count column ``tokenizer``."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"),
                       (F.col(f"`{tokenizer}`") * sign).alias("n_tokens"))


class Rollup:
    """Totals under ``path`` of a file system that all machines share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _done(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def _folders(self, kind: str) -> list[str]:
        fs, p = self._fs(self.path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith(kind))

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest complete base and the batch ids it contains."""
        for name in reversed(self._folders("base-")):
            if self._done(f"{self.path}/{name}/ids") and self._done(f"{self.path}/{name}/totals"):
                ids = self.spark.read.schema("id string").parquet(f"{self.path}/{name}/ids").collect()
                return name, {r[0] for r in ids}
        return None, set()

    def committed(self) -> set[str]:
        own = {n[len("batch-"):] for n in self._folders("batch-") if self._done(f"{self.path}/{n}")}
        return own | self._base()[1]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch once; False if it is already in."""
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError("a batch id has letters, digits, '_', '.' and '-' only")
        if batch_id in self.committed():
            return False
        delta = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        delta.write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id}")
        return True

    def totals(self) -> DataFrame:
        base, folded = self._base()
        parts = [f"{self.path}/{n}" for n in self._folders("batch-")
                 if self._done(f"{self.path}/{n}") and n[len("batch-"):] not in folded]
        parts += [f"{self.path}/{base}/totals"] if base else []
        rows = (self.spark.read.schema(DELTA).parquet(*parts) if parts else self.spark.createDataFrame([], DELTA))
        return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs != 0 OR n_tokens != 0"))

    def compact(self) -> None:
        """One base in place of the deltas; they stay until it is complete and
        are not read afterwards."""
        ids, n = sorted(self.committed()), len(self._folders("base-"))
        where = f"{self.path}/base-{n:09d}"
        self.totals().coalesce(1).write.mode("overwrite").parquet(f"{where}/totals")
        self.spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("overwrite").parquet(
            f"{where}/ids")
