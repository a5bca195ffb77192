"""Sharding by histogram sort (operator 4).

Rows are ordered by (hash of the text, id) and cut into ``shards`` ranges of
nearly equal bytes. Candidate boundaries (*probes*) are refined: each round
counts, exactly and over all rows, the bytes and rows below every probe, as one
small partial histogram per task; only these sums reach the driver. Probes are
placed evenly between the smallest and largest key seen between two probes, so
a group of equal texts that holds a third of the rows is split by id within a
round or two. A splitter is done when the bytes it can be off by are within
``tolerance`` of a shard's share; with tolerance 0 the last few hundred rows
between two probes are looked at themselves and the splitter is exact: a row
belongs to shard ``floor(bytes before it * shards / all bytes)``.

Then the rows are exchanged once, into ``ranges`` or more sub-ranges per shard
(of at most about 32 MB each) whose exact row counts give every row its place in its shard without a window over a
whole shard.

Size is the UTF-8 bytes of the text (null: none) plus 8. Defined results: a
null text sorts by the hash of null, a null id before all others; repeated rows
(same id and text) stay together; an empty table gives no rows; other columns
are carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

RANGE_BYTES = 32 << 20       # most of a sub-range; their number is bounded by all bytes over this
PROBES = 16                 # new probes per open splitter and round
LOOK = 256                  # rows between two probes that are looked at themselves
MAX_ROUNDS = 64
_SIGN = np.uint64(1 << 63)


def _keys(h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Sortable 16-byte keys of (hash, id)."""
    out = np.empty((len(h), 2), ">u8")
    out[:, 0] = h.astype(np.int64).view(np.uint64) ^ _SIGN
    out[:, 1] = i.astype(np.int64).view(np.uint64) ^ _SIGN
    return np.frombuffer(out.tobytes(), "S16")


def _as_int(key: bytes) -> int:
    return int.from_bytes(key.ljust(16, b"\0"), "big")


def _as_key(x: int) -> bytes:
    return x.to_bytes(16, "big")


HISTOGRAM = "_at bigint, _bytes bigint, _rows bigint, _lo binary, _hi binary"


def histogram(keyed: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """(bytes, rows, smallest, largest key) between neighbouring probes.

    Interval 0 is below the first probe; a key equal to a probe is above it.
    """
    bounds = np.array([_as_key(p) for p in probes], "S16")

    def count(batches):
        total: dict[int, list] = {}
        for b in batches:
            if not b.num_rows:
                continue
            k = _keys(b.column("_h").to_numpy(), b.column("_i").to_numpy())
            size = b.column("size").to_numpy()
            order = np.argsort(k, kind="stable")
            k, size = k[order], size[order]
            at = np.searchsorted(bounds, k, "right")
            start = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
            end = np.append(start[1:], len(at)) - 1
            sums = np.add.reduceat(size, start)
            for a, s, n, lo, hi in zip(at[start], sums, end - start + 1, k[start], k[end]):
                t = total.get(int(a))
                total[int(a)] = [int(s), int(n), lo, hi] if t is None else [
                    t[0] + int(s), t[1] + int(n), min(t[2], lo), max(t[3], hi)]
        if total:
            rows = [(a, *t) for a, t in total.items()]
            cols = list(zip(*rows))
            pad = lambda xs: [bytes(x).ljust(16, b"\0") for x in xs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(pad(cols[3]), pa.binary()), pa.array(pad(cols[4]), pa.binary())],
                names=["_at", "_bytes", "_rows", "_lo", "_hi"])
    got = (keyed.mapInArrow(count, HISTOGRAM).groupBy("_at")
           .agg(F.sum("_bytes"), F.sum("_rows"), F.min("_lo"), F.max("_hi")).collect())
    return {r[0]: (r[1], r[2], _as_int(bytes(r[3])), _as_int(bytes(r[4]))) for r in got}


def _rows_between(keyed: DataFrame, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(key, size) of the rows in the given closed key ranges, in order."""
    lo = np.array([_as_key(a) for a, _ in spans], "S16")
    hi = np.array([_as_key(b) for _, b in spans], "S16")

    def pick(batches):
        for b in batches:
            k = _keys(b.column("_h").to_numpy(), b.column("_i").to_numpy())
            at = np.searchsorted(lo, k, "right") - 1
            yield b.filter(pa.array((at >= 0) & (k <= hi[np.maximum(at, 0)])))
    got = keyed.mapInArrow(pick, keyed.schema).collect()
    k = _keys(np.array([r["_h"] for r in got], np.int64), np.array([r["_i"] for r in got], np.int64))
    return sorted((_as_int(bytes(x)), r["size"]) for x, r in zip(k, got))


def splitters(keyed: DataFrame, shards: int, tolerance: float = 0.0, ranges: int = 8) -> tuple[list, list, list]:
    """(bounds, shard, base): range ``j`` has the keys from ``bounds[j - 1]`` to
    below ``bounds[j]``, belongs to ``shard[j]`` and starts there at row
    ``base[j]``."""
    all_rows = histogram(keyed, [])
    if not all_rows:
        return [], [0], [0]
    total, _, low, high = all_rows[0]
    goals = {s: -(-s * total // shards) for s in range(1, shards)}     # bytes that come before shard s
    slack = int(tolerance * total / shards)
    ranges = max(ranges, -(-total // (shards * RANGE_BYTES)))
    probes = sorted({low + (high - low) * j // (shards * ranges) for j in range(1, shards * ranges)})
    done: dict[int, int] = {}
    for _ in range(MAX_ROUNDS):
        hist = histogram(keyed, probes)
        below, rows_below, look, new = 0, 0, {}, set()
        for a in range(len(probes) + 1):
            size, n, lo, hi = hist.get(a, (0, 0, 0, 0))
            for s in [s for s, g in goals.items() if s not in done and below < g <= below + size]:
                # the splitter is the first key in (lo, hi] with enough bytes before it, or the next row after hi
                if size <= slack:
                    done[s] = hi + 1
                elif n <= LOOK or lo == hi:
                    look[s] = (a, lo, hi, below)
                else:
                    new |= {lo + (hi - lo) * j // (PROBES + 1) for j in range(1, PROBES + 1)} | {hi}
            below += size
        if look:
            rows = _rows_between(keyed, sorted({(lo, hi) for _, lo, hi, _ in look.values() if lo != hi}))
            for s, (a, lo, hi, before) in look.items():
                done[s] = hi + 1
                for key, size in rows:
                    if lo <= key <= hi:
                        if before >= goals[s]:
                            done[s] = key
                            break
                        before += size
        if len(done) == len(goals):
            break
        probes = sorted(set(probes) | (new - {0}))
    else:
        raise RuntimeError("splitters did not meet the tolerance")
    bounds = sorted(set(done.values()))
    # sub-ranges: probes that cut a shard about evenly, with exact counts from one more round
    inner = sorted(set(bounds) | set(probes))
    hist = histogram(keyed, inner)
    step, taken, kept = total // (shards * ranges) + 1, 0, []
    for a, p in enumerate(inner):
        taken += hist.get(a, (0, 0))[0]
        if p in done.values() or taken >= step:
            kept.append(p)
            taken = 0
    hist_rows, rows_in, at = [hist.get(a, (0, 0))[1] for a in range(len(inner) + 1)], [0], 0
    for a, p in enumerate(inner):
        rows_in[-1] += hist_rows[a]
        if at < len(kept) and p == kept[at]:
            rows_in.append(0)
            at += 1
    rows_in[-1] += hist_rows[-1]
    ordered = sorted(done.items())
    shard, base = [], []
    for j in range(len(kept) + 1):
        first = kept[j - 1] if j else -1
        s = max([0, *(s for s, b in ordered if b <= first)])
        base.append(base[-1] + rows_in[j - 1] if shard and shard[-1] == s else 0)
        shard.append(s)
    return kept, shard, base


def shard_by_bytes(docs: DataFrame, shards: int = 24, tolerance: float = 0.0, ranges: int = 8,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with size, shard (0 ..) and slot (0 .. without gaps, per shard);
    columns of these names are replaced."""
    new = ("size", "shard", "slot")
    rest = [c for c in docs.columns if c not in new]
    h, i, place_col, row = "__shard_hash", "__shard_id", "__shard_place", "__shard_row"
    keyed = docs.select(*rest).withColumns({
        "size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8,
        h: F.xxhash64(text_col), i: F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))})
    light = C.stage(keyed.select(F.col(h).alias("_h"), F.col(i).alias("_i"), "size"), "sharding-keys")
    bounds, shard, base = splitters(light, shards, tolerance, ranges)
    C.unstage(light)
    b = np.array([_as_key(x) for x in bounds], "S16")
    shard_of, base_of = np.array(shard), np.array(base)

    @F.pandas_udf("struct<r:int,shard:int,base:bigint>")
    def place(hashes: pd.Series, ids: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(b, _keys(hashes.to_numpy(), ids.to_numpy()), "right")
        return pd.DataFrame({"r": at.astype(np.int32), "shard": shard_of[at].astype(np.int32), "base": base_of[at]})
    order = Window.partitionBy(F.col(place_col)["r"]).orderBy(h, i)
    return (keyed.withColumn(place_col, place(h, i)).withColumn(row, F.row_number().over(order))
            .select(*rest, "size", F.col(place_col)["shard"].alias("shard"),
                    (F.col(place_col)["base"] + F.col(row) - 1).alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its files in slot order."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
