"""MinHash near-duplicate detection with fast similarity sketching (operator 10).

**Sketch.** Each document's set of word shingles is reduced to ``t`` = 128
coordinates by rounds of hashed bin placement (Dahlgaard, Knudsen and Thorup,
2017): in round ``i < t`` every element draws a bin and a value in
``[i, i + 1)``; in round ``i >= t`` every element goes to bin ``i - t``; a bin
keeps its smallest value and the rounds end as soon as every bin is filled, at
the latest after ``2t``. So every coordinate is filled, the share of equal
coordinates is an unbiased estimate of the Jaccard similarity with the
concentration of independent samples, and a set of more than a few hundred
shingles needs one or two passes rather than ``t``.

**Candidates.** 32 bands of 4 coordinates: two sets with similarity 0.8 share
no band with probability 0.59^32 = 5e-8. Inside a band's buckets the 8-bit
sketches are compared, and pairs within five standard deviations of the
threshold are likely. A bucket returns no pairs but one row per member, the
smallest member that likely pairs reach; these rows join the documents into
*clusters*, which contain every link.

**Links.** Documents with the same shingle set form a class; only its smallest
id goes on, so copies are never paired. Inside a cluster every pair is
confirmed on the full sets: the intersections of a block of documents are one
product of their shingle incidence matrix. Again a block returns one row per
member, so a cluster of thousands of near copies costs output in proportion to
its members. Buckets and clusters larger than a block are dealt out as pairs
of chunks.

Defined results: text that is null, empty or without words has an empty set
and links with nothing; rows that share a doc_id are one document, of
which :func:`deduplicate` keeps one row per text; a null doc_id links with
nothing, has a null component and is kept; extra columns are ignored by
:func:`near_duplicates` and carried by :func:`deduplicate`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

T, BANDS, ROWS = 128, 32, 4
BIN_SHIFT = np.uint64(64 - 7)          # 2^7 = T bins
LOW = np.uint64((1 << 56) - 1)
BLOCK = 512                            # rows of one side of a block comparison
COLUMNS = 8192                         # shingles of one product


# ------------------------------------------------------------------ sketches

def fast_similarity_sketch(elements: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sketches (documents x T) of concatenated sets of 64-bit element hashes.

    Empty sets give rows of the largest value.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    docs = len(lengths)
    sketch = np.full(docs * T, full)
    owner = np.repeat(np.arange(docs, dtype=np.int64), lengths)
    for i in range(2 * T):
        if not len(elements):
            break
        m = C.mix(elements + C._odd(2000 + i))
        place = (m >> BIN_SHIFT).astype(np.int64) if i < T else np.full(len(m), i - T)
        np.minimum.at(sketch, owner * T + place, (np.uint64(i) << np.uint64(56)) | (m & LOW))
        unfilled = (sketch.reshape(docs, T) == full).any(axis=1)
        going = unfilled[owner]
        elements, owner = elements[going], owner[going]
    return sketch.reshape(docs, T)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band."""
    s = C.mix(sketch).reshape(len(sketch), BANDS, ROWS)
    key = np.zeros((len(sketch), BANDS), np.uint64)
    for j in range(ROWS):
        key += s[:, :, j] * C._odd(j)
    return C.mix(key + np.arange(BANDS, dtype=np.uint64) * C.GOLDEN)


def short_sketch(sketch: np.ndarray) -> np.ndarray:
    return (C.mix(sketch) >> np.uint64(56)).astype(np.uint8)


def least_agreement(threshold: float) -> int:
    """Equal 8-bit coordinates below which a pair cannot reach ``threshold``
    but with the probability of a five-sigma deviation."""
    mean = T * (threshold + (1 - threshold) / 256)
    return int(mean - 5 * (T * threshold * (1 - threshold)) ** 0.5)


SKETCHES = "_id bigint, _n bigint, _k1 bigint, _k2 bigint, _sk binary, _bands array<bigint>"


def _sketcher(k: int):
    def run(batches):
        C._WORDS.use()
        for b in C.slices(batches):
            sets = [C.shingle_set(C.words_of(t.lower() if t else t), k)
                    for t in b.column("_text").to_pylist()]
            lengths = np.fromiter(map(len, sets), np.int64, len(sets))
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            sk = fast_similarity_sketch(flat, lengths)
            owner = np.repeat(np.arange(len(sets)), lengths)
            k1, k2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            np.add.at(k1, owner, C.mix(flat + np.uint64(11)))
            np.add.at(k2, owner, C.mix(flat ^ np.uint64(0x5DEECE66D)))
            some = np.where(lengths > 0, BANDS, 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), C.long_array(lengths), C.long_array(k1), C.long_array(k2),
                 pa.array([r.tobytes() for r in short_sketch(sk)], pa.binary()),
                 C.list_array(band_keys(sk)[lengths > 0].ravel().view(np.int64), some, pa.int64())],
                names=["_id", "_n", "_k1", "_k2", "_sk", "_bands"])
    return run


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, 128-bit set key, 8-bit sketch and band keys of every row."""
    C.small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    return src.mapInArrow(_sketcher(k), SKETCHES)


# --------------------------------------------------------------------- blocks

def _deal(rows: DataFrame, key: str, large: DataFrame) -> DataFrame:
    """Rows of groups (``large``: key, _parts) with the pairs of chunks in which
    each meets its whole group; a group of one chunk is one block."""
    return (rows.join(large, key)
            .withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.col("_parts")))
            .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
            .withColumns({"_bi": F.least("_chunk", "_other"), "_bj": F.greatest("_chunk", "_other")})
            .drop("_other", "_parts"))


def _groups_of(rows: DataFrame, key: str) -> DataFrame:
    return (rows.groupBy(key).agg(F.count("*").alias("_m")).where("_m > 1")
            .select(key, F.ceil(F.col("_m") / BLOCK).cast("long").alias("_parts")))


def _in_blocks(dealt: DataFrame, key: str, fn) -> DataFrame:
    return (dealt.repartition(key, "_bi", "_bj").sortWithinPartitions(key, "_bi", "_bj")
            .mapInArrow(fn, "a bigint, b bigint").distinct())


def _sides(chunk: np.ndarray, bi: int, bj: int) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(chunk == bi), np.flatnonzero(chunk == bj)


def _out(ids: list[np.ndarray], labels: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(ids), np.concatenate(labels)
    return pa.RecordBatch.from_arrays([C.long_array(a[a != b]), C.long_array(b[a != b])], names=["a", "b"])


def _likely(least: int, ratio: float):
    """(member, smallest member that likely pairs reach) per bucket."""
    def close(x, y, nx, ny):
        return ((x == y).sum(axis=-1, dtype=np.int16) >= least) & (
            np.minimum(nx, ny) >= ratio * np.maximum(nx, ny) - 1e-9)

    def run(batches):
        for t, bounds in C.grouped(batches, ["_key", "_bi", "_bj"]):
            ids, n, chunk, bi, bj = (t.column(c).to_numpy() for c in ("_id", "_n", "_chunk", "_bi", "_bj"))
            sk = C.bytes_matrix(t.column("_sk"), np.uint8)
            size = np.diff(bounds)
            two = bounds[:-1][size == 2]
            two = two[(bi[two] == bj[two]) & close(sk[two], sk[two + 1], n[two], n[two + 1])]
            out = [[ids[two], ids[two + 1]], [np.minimum(ids[two], ids[two + 1])] * 2]
            for s, e in zip(bounds[:-1][size > 2], bounds[1:][size > 2]):
                left, right = (s + x for x in _sides(chunk[s:e], bi[s], bj[s]))
                pairs = [np.flatnonzero(close(sk[i], sk[right], n[i], n[right])) for i in left]
                i = np.repeat(left, list(map(len, pairs))) - s
                j = right[np.concatenate(pairs)] - s if pairs else i
                out[0].append(ids[s:e])
                out[1].append(C.block_labels(e - s, i, j, ids[s:e]))
            yield _out(*out)
    return run


def likely_clusters(sk: DataFrame, percent: int) -> DataFrame:
    """(node, component) of documents that likely pairs connect."""
    rows = sk.select("_id", F.explode("_bands").alias("_key"))
    large = _groups_of(rows, "_key")
    dealt = _deal(rows, "_key", large).join(sk.select("_id", "_n", "_sk"), "_id")
    return C.connected_components(_in_blocks(dealt, "_key", _likely(least_agreement(percent / 100), percent / 100)))


def _set_maker(k: int):
    def run(batches):
        for b in C.slices(batches, 500):
            sets = [C.shingle_set(C.words_of(t.lower() if t else t), k).tobytes() for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_key"), pa.array(sets, pa.binary())], names=["_id", "_key", "_set"])
    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, all against all, as products
    of incidence matrices; shingles of one side only cannot count."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return out

    def incidence(sets):
        row = np.repeat(np.arange(len(sets)), list(map(len, sets)))
        flat = np.concatenate(sets)
        col = np.searchsorted(shared, flat)
        ok = shared[np.minimum(col, len(shared) - 1)] == flat
        order = np.argsort(col[ok], kind="stable")
        return row[ok][order], col[ok][order]

    def slab(side, n, c):
        row, col = side
        s, e = np.searchsorted(col, [c, c + COLUMNS])
        m = np.zeros((n, min(COLUMNS, len(shared) - c)), np.float32)
        m[row[s:e], col[s:e] - c] = 1
        return m
    a, b = incidence(left), incidence(right)
    for c in range(0, len(shared), COLUMNS):
        out += slab(a, len(left), c) @ slab(b, len(right), c).T
    return out


def _linked(percent: int):
    """(member, smallest member that links reach) per block of a cluster."""
    def run(batches):
        for t, bounds in C.grouped(batches, ["_key", "_bi", "_bj"]):
            ids, chunk, bi, bj = (t.column(c).to_numpy() for c in ("_id", "_chunk", "_bi", "_bj"))
            sets = t.column("_set")
            out = [[], []]
            for s, e in zip(bounds[:-1], bounds[1:]):
                own = [np.frombuffer(x, np.uint64) for x in sets.slice(s, e - s).to_pylist()]
                left, right = _sides(chunk[s:e], bi[s], bj[s])
                if not len(left) or not len(right):
                    continue
                size = np.fromiter(map(len, own), np.int64, len(own))
                if e - s == 2 and bi[s] == bj[s]:
                    both = np.array([[len(np.intersect1d(*own, assume_unique=True))]])
                    left, right = left[:1], right[1:]
                else:
                    both = intersections([own[i] for i in left], [own[j] for j in right]).astype(np.int64)
                i, j = np.nonzero(100 * both >= percent * (size[left][:, None] + size[right][None, :] - both))
                out[0].append(ids[s:e])
                out[1].append(C.block_labels(e - s, left[i], right[j], ids[s:e]))
            if out[0]:
                yield _out(*out)
    return run


def links_within(clusters: DataFrame, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b), as many as it takes to connect what links connect."""
    members = clusters.toDF("_id", "_key")
    text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    sets = (text.join(members, "_id").mapInArrow(_set_maker(k), "_id bigint, _key bigint, _set binary"))
    return _in_blocks(_deal(sets, "_key", _groups_of(members, "_key")), "_key", _linked(percent))


# ------------------------------------------------------------------- operator

def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links reach; a link is
    ``100 * |A and B| >= percent * |A or B|`` on the sets of lower-cased (A-Z)
    ``k``-word shingles.
    """
    every = C.stage(sketches(docs, k, id_col, text_col), "minhash-sketches")
    usable = every.where("_id IS NOT NULL AND _n > 0")
    same = usable.groupBy("_n", "_k1", "_k2").agg(F.min("_id").alias("_rep"))
    classes = C.stage(usable.select("_id", "_n", "_k1", "_k2").distinct()
                      .join(same, ["_n", "_k1", "_k2"]).select("_id", "_rep").distinct(), "minhash-classes")
    reps = C.stage(usable.join(classes.where("_id = _rep").select("_id"), "_id", "left_semi"), "minhash-reps")

    clusters = C.stage(likely_clusters(reps, percent), "minhash-clusters")
    links = links_within(clusters, docs, k, percent, id_col, text_col)
    # a class is linked in itself, and so is an id with several texts
    ties = classes.where("_id != _rep").select(F.col("_rep").alias("a"), F.col("_id").alias("b"))
    comps = C.connected_components(links.union(ties))

    out = every.select("_id", "_n").join(comps.toDF("_id", "_c"), "_id", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_c", "_id"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are not the first of their component, and
    with one row for each text of a doc_id."""
    found = (near_duplicates(docs, k, percent, id_col, text_col).where("doc_id IS NOT NULL")
             .groupBy(F.col("doc_id").alias("_drop")).agg(F.min("kept").alias("_kept"), F.count("*").alias("_rows")))
    found = C.stage(found.where("NOT _kept OR _rows > 1"), "minhash-drop")
    single = docs.join(found, docs[id_col] == found["_drop"], "left_anti")
    repeated = found.where("_kept").select("_drop")
    if repeated.isEmpty():
        return single
    repeated = C.stage(repeated, "minhash-repeated")
    return single.union(docs.join(repeated, docs[id_col] == repeated["_drop"], "left_semi")
                        .dropDuplicates([id_col, text_col]))
