"""Vector code compression (operator 11): product codes by equal-average search.

A vector becomes integers ``floor(scale * x)`` and is cut into equal consecutive
parts; each part position has a codebook of at most 256 entries, which starts as
that part of the vectors with the smallest ids. A round gives every part to its
nearest entry and moves each entry to the floor of its parts' mean; all is exact
integer arithmetic, so the result does not depend on the partitioning.

Equal-average search: the squared distance of two parts of ``d`` components is at
least ``(difference of their sums)^2 / d``. Entries are sorted by their component
sum, a part begins at the entry whose sum is nearest to its own and goes outward,
nearer sums first; it stops when the next gap squared over ``d`` strictly exceeds
the best distance, so entries that tie with the best are still compared and the
lower index wins.

On Spark: the integers are staged once; a round is one scan that adds up sums and
counts per entry inside each task, and the driver gets ``parts * entries * (d + 1)``
totals, whatever the number of vectors. Nothing but codebooks is sent to tasks.

Defined results: a vector that is null, empty or has a null or non-finite component
is dropped; so is one whose length is not the table's (the most frequent, of ties
the longest); a length that the parts do not divide is an error, as is a component
so large that squares would leave 64 bits (beyond 16,384 at width 64). A null id
sorts last, ties in id by vector. Repeated rows are vectors of their own. With
fewer vectors than entries the codebooks have as many entries as vectors; no rows
give no rows. Other columns are ignored or carried by name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_join, stage, unstage


# ------------------------------------------------------- equal-average search

class SortedBook:
    """One part position's codebook, sorted by component sum."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.entries, self.sums = entries[self.order], sums[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of the nearest entry per row, and the number of comparisons."""
        n, d, k = *x.shape, len(self.sums)
        code, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rows, s = np.arange(n), x.sum(axis=1)
        high = np.searchsorted(self.sums, s)
        low = high - 1
        compared, first = 0, True
        while len(rows):
            below = np.where(low >= 0, s - self.sums[np.maximum(low, 0)], np.iinfo(np.int64).max)
            above = np.where(high < k, self.sums[np.minimum(high, k - 1)] - s, np.iinfo(np.int64).max)
            down = below <= above
            gap = np.where(down, below, above)
            go = (low >= 0) | (high < k)
            if not first:
                gap = np.where(go, gap, 0)
                go &= gap * gap <= d * best[rows]
            rows, s, low, high, down = rows[go], s[go], low[go], high[go], down[go]
            at = np.where(down, low, high)
            dist = ((x[rows] - self.entries[at]) ** 2).sum(axis=1)
            index = self.order[at]
            better = (dist < best[rows]) | ((dist == best[rows]) & (index < code[rows])) if not first else slice(None)
            code[rows[better]], best[rows[better]] = index[better], dist[better]
            low, high = low - down, high + ~down
            compared += len(rows)
            first = False
        return code, best, compared


@dataclass
class Codebooks:
    """``entries``: integers by part, entry and component; ``scale`` makes vectors integer."""

    entries: np.ndarray
    scale: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


# --------------------------------------------------------------------- Spark

def finite(vector: Column) -> Column:
    """True for a vector whose components are all there and finite; not for null."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    return F.coalesce(F.forall(vector, lambda v: F.coalesce(fine(v), F.lit(False))), F.lit(False))


def table_width(vectors: DataFrame, vector_col: str = "embedding") -> int:
    """The most frequent length, of ties the longest; 0 without vectors."""
    row = (vectors.groupBy(F.size(vector_col).alias("w")).count()
           .orderBy(F.col("count").desc(), F.col("w").desc()).first())
    return row["w"] if row else 0


def integer_vectors(vectors: DataFrame, keep: list[str], vector_col: str = "embedding", parts: int = 8,
                    scale: int = 4096) -> tuple[DataFrame, int]:
    """The columns ``keep`` and ``_q`` (integers) of the vectors that are kept, staged; and their length."""
    x = F.col(vector_col).cast("array<double>")
    kept = vectors.select(*keep, x.alias("_x")).where(finite(F.col("_x")) & (F.size("_x") > 0))
    width = table_width(kept, "_x")
    if width % parts:
        raise ValueError(f"vectors of length {width} cannot be cut into {parts} equal parts")
    most = math.isqrt(2 ** 61 // max(1, width * (width // parts)))
    q = F.transform("_x", lambda v: F.when(F.abs(v * scale) < most, F.floor(v * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is not below {most}")).cast("int")))
    return stage(kept.where(F.size("_x") == width).select(*keep, q.alias("_q")), "codes-integers"), width


def _matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The ``_q`` column as rows x parts x components."""
    q = batch.column("_q")
    return q.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, parts, -1)


def _entry_sums(books: np.ndarray):
    """mapInArrow function: per task, sums (component 0 on) and counts (-1) of each entry's parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, d = books.shape
        sorted_books = [SortedBook(b) for b in books]
        sums, counts = np.zeros((parts, k, d), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, parts)
                for p in range(parts):
                    code, _, _ = sorted_books[p].nearest(x[:, p])
                    np.add.at(sums[p], code, x[:, p])
                    counts[p] += np.bincount(code, minlength=k)
        p, e = np.nonzero(counts)
        if len(p):
            both = np.concatenate([counts[p, e][:, None], sums[p, e]], axis=1)
            long = lambda a: pa.array(np.repeat(a, d + 1), pa.int32())
            yield pa.record_batch([long(p), long(e), pa.array(np.tile(np.arange(-1, d), len(p)), pa.int32()),
                                   pa.array(both.ravel())], ["part", "entry", "component", "total"])
    return run


def fit(integers: DataFrame, width: int, id_col: str = "vec_id", parts: int = 8, entries: int = 16,
        rounds: int = 6, scale: int = 4096) -> Codebooks:
    """Codebooks of staged integer vectors. ``entries`` is at most 256."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    first = integers.orderBy(F.col(id_col).asc_nulls_last(), "_q").limit(entries).select("_q").collect()
    books = np.array([r["_q"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    for _ in range(rounds if first else 0):
        totals = (integers.select("_q").mapInArrow(_entry_sums(books.copy()),
                                                   "part int, entry int, component int, total long")
                  .groupBy("part", "entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        moved = {(r["part"], r["entry"], r["component"]): int(r["total"]) for r in totals.collect()}
        for (p, e, c), total in moved.items():
            if c >= 0:
                books[p, e, c] = total // moved[p, e, -1]
    return Codebooks(books, scale)


def encode(integers: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``code`` (two hex digits a part), ``error`` (squared distances, long) and ``n_compared``
    (entries compared, of parts x entries) to the other columns of staged integer vectors."""
    carried = [c for c in integers.columns if c != "_q"]
    entries = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(entries)
        sorted_books = [SortedBook(b) for b in entries]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _matrix(batch, parts), batch.num_rows
            codes, error = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
            compared = 0
            for p in range(parts):
                code, dist, tried = sorted_books[p].nearest(x[:, p])
                codes[:, p], error, compared = code, error + dist, compared + tried
            digits = codes.tobytes().hex()
            hexes = [digits[i:i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            share = np.full(n, compared // n, np.int64)
            share[:compared % n] += 1
            yield pa.record_batch([*(batch.column(c) for c in carried), pa.array(hexes, pa.string()), pa.array(error),
                                   pa.array(share)], [*carried, "code", "error", "n_compared"])

    fields = [*(f"`{c}` {integers.schema[c].dataType.simpleString()}" for c in carried),
              "code string", "error long", "n_compared long"]
    return integers.mapInArrow(run, ", ".join(fields))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256, n_compared.

    ``n_compared`` says how many entries the search compared; it is shared out evenly inside a batch.
    """
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                           F.col(vector_col).alias("embedding"))
    integers, width = integer_vectors(named, ["vec_id", "label"], "embedding", parts, scale)
    books = fit(integers, width, "vec_id", parts, entries, rounds, scale)
    coded = stage(encode(integers, books), "codes")
    unstage(integers)
    totals = stage(coded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "codes-labels")
    return keyed_join(coded, totals, "label", ["vec_id", "code"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"), "n_compared")
