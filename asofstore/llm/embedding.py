"""Embedding near-duplicates by randomised-rotation binary codes (operator 2).

**Code.** A unit vector ``o`` (padded with zeros to ``D`` = 256 dimensions) is
turned by a fixed random rotation ``P``; its code is the signs of ``P o``, i.e.
the unit vector ``b`` of the hypercube's corners closest to ``P o``. Stored with
it is the correction factor ``c = <b, P o>`` (Gao and Long, 2024). For any unit
vector ``q``, ``<b, P q> / c`` is an unbiased estimate of ``<o, q>`` whose error
is within ``EPSILON * sqrt((1 - c^2) / (c^2 (D - 1)))`` but with a probability
that falls as a Gaussian tail in ``EPSILON``.

**Which pairs are estimated.** ``tables`` hash tables each take ``k`` of the
code's bits as the key. Two vectors at the threshold agree in a bit with
probability ``1 - acos(t) / pi``; ``k`` follows the number of vectors (about 16
to a bucket) and the number of tables follows from ``k`` so that a pair exactly
at the threshold is missed with probability ``miss`` at most, closer pairs less
often; all tables draw from one code, so the number is taken from the joint
distribution (:func:`missed`). Work is ``n * tables``, not ``n^2``.

**Deciding.** Inside a bucket the estimate plus its bound rules out pairs; all
others are recomputed exactly in double precision, and only exact cosines make
links. A pair counts in the first table in which it meets. Buckets larger than
``BLOCK`` are dealt out as pairs of chunks. No pair leaves a block: a block
returns, for each vector with links, how many it has and a vector of the
block's component, so a group of near copies costs output in proportion to its
members. Equal vectors are one class throughout and are never paired.

Defined results: a vector that is null, empty, zero or has null or non-finite
components links with nothing (0 links, its own component); vectors of
different lengths are not compared; a null vec_id links with nothing, has a
null component and is kept; repeated rows are equal vectors and count as links
of each other; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

D = 256
EPSILON = 5.0
BLOCK = 1024
SEED = 20260


def rotation(dim: int) -> np.ndarray:
    """``width`` x ``dim``: the columns of a random rotation that meet the
    unpadded coordinates; ``width`` is at least D and a multiple of 64."""
    width = max(D, -(-dim // 64) * 64)
    rng = np.random.default_rng([SEED, dim])
    q, r = np.linalg.qr(rng.standard_normal((width, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def table_bits(dim: int, k: int, tables: int) -> np.ndarray:
    width = max(D, -(-dim // 64) * 64)
    rng = np.random.default_rng([SEED, dim, k])
    return np.stack([rng.choice(width, k, replace=False) for _ in range(tables)])


def missed(k: int, tables: int, cosine: float) -> float:
    """Probability that two vectors at ``cosine`` share no key. All tables draw
    from the same ``D`` bits, so the average is over the number of bits in
    which the pair differs; a wider code misses less."""
    p = math.acos(cosine) / math.pi
    d = np.arange(D - k + 1)
    choose = np.array([math.lgamma(D + 1) - math.lgamma(x + 1) - math.lgamma(D - x + 1) for x in d])
    chance = np.exp(choose + d * math.log(p) + (D - d) * math.log1p(-p)) if p else (d == 0).astype(float)
    share = np.cumprod(np.concatenate([[1.0], 1 - k / (D - d[:-1])]))     # all k bits among the D - d equal ones
    none = np.where(share < 1, np.exp(tables * np.log1p(-np.minimum(share, 1 - 1e-16))), 0.0)
    return float(chance @ none + max(0.0, 1 - chance.sum()))


def plan_tables(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits per key, number of tables) for ``n`` vectors."""
    k = min(max(math.ceil(math.log2(max(n, 2) / 16)), 6), 48)
    high = 1
    while missed(k, high, threshold) > miss:
        high *= 2
        if high > 1 << 20:
            raise ValueError(f"no number of tables misses at most {miss} at cosine {threshold}")
    low = high // 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if missed(k, mid, threshold) > miss else (low, mid)
    return k, high


def bucket_keys(bits: np.ndarray, chosen: np.ndarray, dim: int) -> np.ndarray:
    """One 64-bit key per vector and table."""
    weight = np.uint64(1) << np.arange(chosen.shape[1], dtype=np.uint64)
    out = np.empty((len(bits), len(chosen)), np.uint64)
    for t, idx in enumerate(chosen):
        out[:, t] = bits[:, idx].astype(np.uint64) @ weight
    salt = np.arange(len(chosen), dtype=np.uint64) * C.GOLDEN + np.uint64(dim)
    return C.mix(C.mix(out) + salt)


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


# ---------------------------------------------------------------------- codes

CODED = "_rep bigint, _mult bigint, _vec binary, _code binary, _c double, _dim int"


def _coder(batches):
    for b in C.slices(batches):
        vecs, dims = b.column("_vec").to_pylist(), b.column("_dim").to_numpy()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = np.array([vecs[i] for i in at], np.float64) + 0.0     # no negative zeros
            turned = unit(x) @ rotation(int(d)).T.astype(np.float64)
            bits = turned > 0
            c = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("_rep").take(take), b.column("_mult").take(take),
                 pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([r.tobytes() for r in np.packbits(bits, axis=1)], pa.binary()),
                 pa.array(c), pa.array(dims[at].astype(np.int32))],
                names=["_rep", "_mult", "_vec", "_code", "_c", "_dim"])


def codes(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Classes of equal usable vectors with code and correction factor."""
    v = vectors.select(F.col(id_col).cast("long").alias("_id"),
                       F.col(vec_col).cast("array<double>").alias("_vec"))
    usable = v.where(F.col("_id").isNotNull() & (F.size("_vec") > 0)
                     & F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                     & F.exists("_vec", lambda x: x != 0))
    same = usable.groupBy("_vec").agg(F.min("_id").alias("_rep"), F.count("*").alias("_mult"))
    return same.select("_rep", "_mult", "_vec", F.size("_vec").alias("_dim")).mapInArrow(_coder, CODED)


# --------------------------------------------------------------------- blocks

def estimates(bits: np.ndarray, c: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded vectors (rows) with turned unit
    vectors (columns), and the half-width of their confidence bound."""
    width = turned.shape[1]
    corner = (bits.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(width))
    est = (corner @ turned.T) / c[:, None].astype(np.float32)
    return est, EPSILON * np.sqrt((1 - c ** 2).clip(0) / (c ** 2 * (width - 1)))


def _linker(threshold: float, k: int, tables: int):
    turn: dict[int, np.ndarray] = {}

    def run(batches):
        out = [[], [], []]
        for t, bounds in C.grouped(batches, ["_key", "_dim", "_bi", "_bj"]):
            rep, mult, chunk, table, dims, all_c, bi, bj = (t.column(x).to_numpy() for x in (
                "_rep", "_mult", "_chunk", "_table", "_dim", "_c", "_bi", "_bj"))
            vec, code = t.column("_vec"), t.column("_code")
            for s, e in zip(bounds[:-1], bounds[1:]):
                left, right = np.flatnonzero(chunk[s:e] == bi[s]), np.flatnonzero(chunk[s:e] == bj[s])
                if e - s < 2 or not len(left) or not len(right):
                    continue
                dim, ids = int(dims[s]), rep[s:e]
                if dim not in turn:
                    turn[dim] = rotation(dim)
                x = unit(C.bytes_matrix(vec.slice(s, e - s), np.float64))
                bits = np.unpackbits(C.bytes_matrix(code.slice(s, e - s), np.uint8), axis=1)
                est, bound = estimates(bits[left], all_c[s:e][left], x[right].astype(np.float32) @ turn[dim].T)
                i, j = np.nonzero(est + bound[:, None].astype(np.float32) >= threshold)
                i, j = left[i], right[j]
                once = ids[i] < ids[j] if bi[s] == bj[s] else ids[i] != ids[j]
                i, j = i[once], j[once]
                exact = [np.einsum("ij,ij->i", x[i[p:p + 65536]], x[j[p:p + 65536]]) for p in range(0, len(i), 65536)]
                ok = np.concatenate(exact) >= threshold if exact else np.zeros(0, bool)
                i, j = i[ok], j[ok]
                if table[s] and len(i):     # pairs that met in an earlier table are counted there
                    keys = bucket_keys(bits, table_bits(dim, k, tables)[:table[s]], dim)
                    new = np.ones(len(i), bool)
                    for p in range(table[s]):
                        new &= keys[i, p] != keys[j, p]
                    i, j = i[new], j[new]
                if not len(i):
                    continue
                links = np.zeros(e - s, np.int64)
                np.add.at(links, i, mult[s:e][j])
                np.add.at(links, j, mult[s:e][i])
                has = links > 0
                for o, a in zip(out, (ids[has], links[has], C.block_labels(e - s, i, j, ids)[has])):
                    o.append(a)
            if out[0]:
                yield pa.RecordBatch.from_arrays([C.long_array(np.concatenate(o)) for o in out],
                                                 names=["_rep", "_links", "_label"])
                out = [[], [], []]
    return run


def _bucketer(k: int, tables: int):
    def run(batches):
        for b in C.slices(batches):
            dims = b.column("_dim").to_numpy()
            code = b.column("_code").to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                bits = np.unpackbits(np.stack([np.frombuffer(code[i], np.uint8) for i in at]), axis=1)
                keys = bucket_keys(bits, table_bits(int(d), k, tables), int(d))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_rep").take(pa.array(at)),
                     C.list_array(keys.ravel().view(np.int64), np.full(len(at), tables), pa.int64())],
                    names=["_rep", "_keys"])
    return run


def links_within(coded: DataFrame, threshold: float, miss: float) -> DataFrame:
    """(_rep, _links, _label) partial results of all blocks."""
    k, tables = plan_tables(coded.count(), threshold, miss)
    keys = (coded.select("_rep", "_code", "_dim").mapInArrow(_bucketer(k, tables), "_rep bigint, _keys array<bigint>")
            .select("_rep", F.posexplode("_keys").alias("_table", "_key")))
    keys = C.stage(keys, "embedding-keys")
    shared = (keys.groupBy("_key").agg(F.count("*").alias("_m")).where("_m > 1")
              .select("_key", F.ceil(F.col("_m") / BLOCK).cast("long").alias("_parts")))
    dealt = (keys.join(shared, "_key")
             .withColumn("_chunk", F.pmod(F.xxhash64("_rep"), F.col("_parts")))
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
             .select("_rep", "_key", "_table", "_chunk", F.least("_chunk", "_other").alias("_bi"),
                     F.greatest("_chunk", "_other").alias("_bj")))
    return (dealt.join(coded, "_rep").repartition("_key", "_bi", "_bj")
            .sortWithinPartitions("_key", "_dim", "_bi", "_bj")
            .mapInArrow(_linker(threshold, k, tables), "_rep bigint, _links bigint, _label bigint"))


# ------------------------------------------------------------------- operator

def near_duplicates(vectors: DataFrame, threshold: float = 0.9, miss: float = 0.005,
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    coded = C.stage(codes(vectors, id_col, vec_col), "embedding-codes")
    found = C.stage(links_within(coded, threshold, miss), "embedding-links")
    comps = C.connected_components(found.select(F.col("_rep").alias("a"), F.col("_label").alias("b")))
    total = found.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    classes = (coded.select("_rep", "_mult", "_vec").join(total, "_rep", "left")
               .join(comps.toDF("_rep", "_comp"), "_rep", "left")
               .select(F.xxhash64("_vec").alias("_h"), F.col("_vec").alias("_bytes"),
                       (F.coalesce("_links", F.lit(0)) + F.col("_mult") - 1).alias("_links"),
                       F.coalesce("_comp", "_rep").alias("_comp")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("_id"),
                           F.col(vec_col).cast("array<double>").alias("_v"))
            .mapInArrow(_packer, "_id bigint, _b binary").withColumn("_hh", F.xxhash64("_b")))
    out = rows.join(classes, F.col("_id").isNotNull() & (F.col("_hh") == F.col("_h"))
                    & (F.col("_b") == F.col("_bytes")), "left")
    component = F.coalesce("_comp", "_id")
    return out.select(F.col("_id").alias("vec_id"), F.coalesce("_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


def _packer(batches):
    """The vectors' bytes as the coder writes them (null where not usable)."""
    for b in C.slices(batches):
        packed = []
        for v in b.column("_v").to_pylist():
            whole = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
            packed.append((np.array(v, np.float64) + 0.0).tobytes() if whole else None)
        yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(packed, pa.binary())], names=["_id", "_b"])
