"""Shared helpers of the training-data operators.

Conventions that hold for every operator in this subpackage:

* ``documents``-like input needs the id and text columns only; any other
  column is carried or ignored, and internal columns are named ``_x`` so that
  they do not meet the caller's names.
* Intermediate tables that are read more than once are written to the shared
  folder of ``spark.checkpoint.dir`` and read back, so a lost executor costs
  the lost tasks and not the lineage before them.
* Python code runs in ``mapInArrow`` over bounded record batches; grouping,
  joins and exchanges are Spark's.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ROWS_PER_BATCH = 2000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in batches of at most 1,000 rows: memory
    on both sides is bounded by a batch. A smaller setting of the caller stays."""
    now = int(spark.conf.get(BATCH, "10000"))
    if now <= 0 or now > 1000:
        spark.conf.set(BATCH, "1000")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The job's shuffle files go with the job: nothing after it reads them.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, f"llm-{name}")
    small_batches(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._staged)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --------------------------------------------------------------- word hashes

class Remembered(dict):
    """What a Python worker remembers, up to a bound: a full half becomes the
    old half, and what is asked for again moves over, so frequent keys stay.

    Workers outlive their tasks and serve one operator after the other, so a
    task that begins to use one memory drops the others.
    """

    LIMIT = 300_000
    _all: list[weakref.ref] = []

    def __init__(self):
        super().__init__()
        self.old: dict = {}
        self._all.append(weakref.ref(self))

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.LIMIT // 2:
            self.old = dict(self)
            super().clear()
        self[key] = value
        return value

    def clear(self):
        super().clear()
        self.old = {}

    def use(self):
        for ref in self._all:
            other = ref()
            if other is not None and other is not self:
                other.clear()
        return self


class WordHashes(Remembered):
    """64-bit xxh3 of each word."""

    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)


_WORDS = WordHashes()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text; none for null."""
    return text.split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element-wise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(i: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(b"odd%d" % i) | 1)


def gram_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (empty if fewer)."""
    n = len(w) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += w[j:j + n] * _odd(j)
    return mix(out)


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; with fewer words the
    whole sequence is one shingle; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    w = hash_words(words)
    if len(w) < k:
        whole = gram_hashes(w, len(w)) ^ _odd(1000 + len(w))
        return whole
    return np.unique(gram_hashes(w, k))


# ------------------------------------------------------------ Arrow plumbing

def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_PER_BATCH) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds) from a stream sorted by non-null long keys: group ``i`` is
    the rows from ``bounds[i]`` to ``bounds[i + 1]``, and every group is whole."""
    rest: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        k = np.stack([t.column(c).to_numpy() for c in keys])
        bounds = np.flatnonzero(np.concatenate([[True], (k[:, 1:] != k[:, :-1]).any(axis=0)]))
        if len(bounds) > 1:
            yield t.slice(0, bounds[-1]).combine_chunks(), bounds
        rest = t.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def bytes_matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Rows of equally long binaries as a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def block_labels(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that the links (i, j) reach from each of ``n`` rows."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return label


def long_array(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


# ------------------------------------------------------ connected components

def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long, not null);
    component is the smallest node reachable.

    Alternating large-star / small-star rounds (Kiveris et al., 2014): each
    round is two aggregations with map-side combining and two equi-joins whose
    hot keys adaptive execution can split; the number of rounds grows with the
    logarithm of the component size. Each round is written to the shared
    folder. Empty input gives an empty result.
    """
    e = stage(edges.where("a != b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = _digest(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .distinct())
        least_of = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least_of, "a")
        last, e = e, stage(small.select("a", F.col("m").alias("b"))
                           .union(small.where("b != m").select(F.col("b"), F.col("m"))).distinct(), "cc")
        unstage(last)
        now = _digest(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node")).distinct()
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))


def _digest(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


# ---------------------------------------------------------------- keyed joins

def keyed_join(rows: DataFrame, keyed: DataFrame, key: str, salt_from: list[str], how: str = "left",
               most: int = 100_000, salts: int = 16) -> DataFrame:
    """``rows`` with the other columns of ``keyed``, a staged table of one small row per ``key``;
    null equals null.

    Up to ``most`` rows ``keyed`` is broadcast (its rows are counted). Beyond that both
    sides are exchanged by key and a salt taken from the columns ``salt_from``, so the rows
    of a frequent key go to ``salts`` tasks.
    """
    named = keyed.withColumnRenamed(key, "_key")
    if keyed.count() <= most:
        return rows.join(F.broadcast(named), rows[key].eqNullSafe(named["_key"]), how).drop("_key")
    named = named.withColumn("_salt_k", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_salt_r", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    return dealt.join(named, dealt[key].eqNullSafe(named["_key"]) & (F.col("_salt_r") == F.col("_salt_k")),
                      how).drop("_key", "_salt_r", "_salt_k")
