"""All windows of the feature store in one pass over sessions that are dealt by driver.

Sessions are first added up to one row per (driver, round, date, session type), which
bounds a driver's rows by the calendar whatever its share of the input; these narrow
rows and the reference dates of eligible drivers are exchanged once, by driver, and
sorted by date. No row is copied to the dates that see it. Inside a task, for whole
drivers at a time:

* a date sees its driver's sessions up to a position, since they are in date order;
  a window of the last N rounds begins at the first of them whose round is not older
  than the oldest round of the window (a key per date from the calendar);
* a sum over such a run is the difference of two running sums where these are exact
  (all values are multiples of 1/8 and no total comes near 2^53, which counts always
  are); else it is put together from blocks of 1, 2, 4, ... sessions that are added up
  once (at most two per size), so nothing is subtracted and sums keep their precision;
  distinct seasons are bit sets that are joined from blocks;
* rounds held out of date order leave sessions in a run that are too old for it. The
  least key of the run, from the same blocks, shows these runs; their sessions are
  picked one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import asof

CHUNK = 40_000
OLDEST = np.iinfo(np.int64).min
ROUND_KEY = "CAST(year AS BIGINT) * 4294967296 + roundnumber"


# ----------------------------------------------------------------- block sums

def _blocks(values: np.ndarray, join) -> list[np.ndarray]:
    """Level k joins runs of 2^k neighbouring rows."""
    levels = [values]
    while len(levels[-1]) > 1:
        last = levels[-1]
        even = len(last) // 2 * 2
        levels.append(join(last[:even:2], last[1:even:2]))
    return levels


def _over_runs(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray, join, start) -> np.ndarray:
    """``join`` of the rows from ``low`` to before ``high`` of each query; ``start`` where there is none."""
    out = np.full((len(low), *levels[0].shape[1:]), start, levels[0].dtype)
    low, high, at = low.copy(), np.maximum(low, high), np.arange(len(low))
    for level in levels:
        open_ = low < high
        low, high, at = low[open_], high[open_], at[open_]
        if not len(at):
            break
        odd = (low & 1) == 1
        out[at[odd]] = join(out[at[odd]], level[low[odd]])
        low = low + odd
        odd = ((high & 1) == 1) & (low < high)
        out[at[odd]] = join(out[at[odd]], level[high[odd] - 1])
        high = high - odd
        low, high = low >> 1, high >> 1
    return out


def _running(values: np.ndarray) -> np.ndarray | None:
    """Sums of the rows before each row and of all; None unless every one of them is exact."""
    eighths = values * 8
    if not (eighths == np.rint(eighths)).all() or not np.abs(eighths).sum() < 2.0 ** 52:
        return None
    return np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])


# -------------------------------------------------------------- one task's work

def _whole_drivers(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    """Tables of whole drivers, of about ``chunk`` rows, from rows sorted by driver."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < chunk:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("driverid").chunk(0)
        same = pc.equal(ids, ids[-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(same)[0])
        if cut:
            yield t.slice(0, cut).combine_chunks()
            held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        else:
            held = t.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _sums(t: pa.Table, states: list[str], windows: list[str]) -> tuple[np.ndarray, np.ndarray, dict]:
    """Which rows are probes and the place of each among the different (driver, date);
    per window (sums: place x state x (all, race, sprint), distinct seasons)."""
    col = lambda c: t.column(c).to_numpy()
    ids = t.column("driverid").chunk(0)
    new = np.append(True, pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False))
    driver = np.cumsum(new) - 1
    session = col("phase") == 0
    probe = np.flatnonzero(~session)
    # probes of one driver and date follow each other
    other = np.append(True, (np.diff(driver[probe]) != 0) | (np.diff(col("t")[probe]) != 0))[:len(probe)]
    place, every = np.cumsum(other) - 1, probe
    probe = probe[other]
    seen = np.cumsum(session)                       # sessions before or at each row
    start = (seen - session)[np.flatnonzero(new)][driver]
    s, d = t.filter(pa.array(session)), driver[session]
    key = s.column("key").fill_null(int(OLDEST)).to_numpy()
    mode = s.column("mode").to_numpy()
    state = np.stack([s.column(c).fill_null(0).to_numpy().astype(float) for c in states], axis=1)
    by_mode = np.stack([state, state * (mode == 0)[:, None], state * (mode == 1)[:, None]], axis=2)
    year = s.column("year")
    known = ~year.is_null().to_numpy()
    year = year.fill_null(0).to_numpy().astype(np.int64)
    first = int(year[known].min()) if known.any() else 0
    bit = np.where(known, year - first, 0)
    seasons = np.zeros((len(year), int(bit.max(initial=0)) // 64 + 1), np.uint64)
    at = np.flatnonzero(known)
    seasons[at, bit[at] // 64] = np.uint64(1) << (bit[at] % 64).astype(np.uint64)
    # the greatest key up to each session is sorted inside a driver, (driver, rank of key) overall
    ranks, rank = np.unique(key, return_inverse=True)
    width = len(ranks) + 1
    top = np.maximum.accumulate(d * width + rank)
    running = _running(by_mode)
    sum_levels = _blocks(by_mode, np.add) if running is None else None
    key_levels = _blocks(key, np.minimum)
    bit_levels = _blocks(seasons, np.bitwise_or)
    high, begin, who = seen[probe], start[probe], driver[probe]
    out = {}
    for w in windows:
        oldest = np.full(len(probe), OLDEST) if w is None else col(f"from{w}")[probe].astype(np.int64)
        low = np.searchsorted(top, who * width + np.searchsorted(ranks, oldest))
        low = np.minimum(np.maximum(low, begin), high)
        sums = _over_runs(sum_levels, low, high, np.add, 0.0) if running is None else running[high] - running[low]
        bits = _over_runs(bit_levels, low, high, np.bitwise_or, 0)
        odd = np.flatnonzero(_over_runs(key_levels, low, high, np.minimum, np.iinfo(np.int64).max) < oldest)
        if len(odd):
            length = high[odd] - low[odd]
            which = np.repeat(np.arange(len(odd)), length)
            rows = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + low[odd][which]
            inside = key[rows] >= oldest[odd][which]
            which, rows = which[inside], rows[inside]
            sums[odd], bits[odd] = 0.0, 0
            np.add.at(sums, odd[which], by_mode[rows])
            np.bitwise_or.at(bits, odd[which], seasons[rows])
        out[w] = sums, np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    return every, place, out


def driver_windows(sessions: DataFrame, bounds: DataFrame, eligible: DataFrame, windows: dict[str, int | None],
                   states: list[tuple[str, str]], features: list[tuple], wanted: set[str] | None = None,
                   chunk: int = CHUNK, carry: list[str] | None = None) -> DataFrame:
    """``(dt_ref, driverid)`` of ``eligible`` with the features of every window ``{suffix: rounds or None}``.

    ``sessions``: rows with driverid, year, roundnumber, d, mode (0 race, 1 sprint, 2 other) and
    what ``states`` (name, SQL) read; ``bounds``: ``(dt_ref, from<suffix>)`` with the key of the oldest
    round of each finite window; ``features``: (name, kind, state, mode index) with kind count, sum,
    avg or seasons. A row is kept where the driver has a session in every window. ``wanted`` limits
    the columns that are made, and the state that is exchanged for them; ``carry`` names columns of ``eligible``
    that its rows keep (a (dt_ref, driverid) may then come several times).
    """
    carry = carry or []
    made = [(f"{name}{w}", kind, state, m, w) for w in windows for name, kind, state, m in features
            if wanted is None or f"{name}{w}" in wanted]
    used = {"n"} | {c for _, _, state, _, _ in made if state for c in (state, f"{state}__s", f"{state}__n")}
    states = [(c, e) for c, e in states if c in used]
    finite = [w for w, n in windows.items() if n is not None]
    narrow = (sessions.where("driverid IS NOT NULL AND d IS NOT NULL")
              .groupBy("driverid", "year", "roundnumber", "d", "mode")
              .agg(*[F.expr(f"sum({e})").alias(c) for c, e in states])
              .selectExpr("driverid", "unix_date(d) AS t", "0 AS phase", f"{ROUND_KEY} AS key", "year", "mode",
                          *[c for c, _ in states]))
    probes = eligible.where("driverid IS NOT NULL")
    if finite:
        probes = probes.join(bounds, "dt_ref")
    probes = probes.selectExpr("driverid", "unix_date(dt_ref) AS t", "1 AS phase", *[f"from{w}" for w in finite],
                               *[f"`{c}` AS `carry_{i}`" for i, c in enumerate(carry)])
    rows = (narrow.unionByName(probes, allowMissingColumns=True).repartition("driverid")
            .sortWithinPartitions("driverid", "t", "phase", "key", "mode"))
    names = [c for c, _ in states]
    place = {c: i for i, c in enumerate(names)}
    needs = {w: n for w, n in windows.items()}
    kinds = dict(eligible.dtypes)
    schema = ["dt_ref date", "driverid string", *(f"`{c}` {kinds[c]}" for c in carry),
              *(f"{c} {'bigint' if kind in ('count', 'seasons') else 'double'}" for c, kind, *_ in made)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [None if n is None else w for w, n in needs.items()]
        for t in _whole_drivers(batches, chunk):
            probe, of, found = _sums(t, names, keys)
            found = {w: found[k] for w, k in zip(needs, keys)}
            kept = np.ones(len(probe), bool)
            for sums, _ in found.values():
                kept &= (sums[:, place["n"], 0] > 0)[of]
            of, at = of[kept], pa.array(probe[kept])
            if not len(at):
                continue
            columns = [t.column("t").take(at).combine_chunks().cast(pa.int32()).view(pa.date32()),
                       t.column("driverid").take(at).combine_chunks(),
                       *[t.column(f"carry_{i}").take(at).combine_chunks() for i in range(len(carry))]]
            for _, kind, state, m, w in made:
                sums, seasons = found[w]
                if kind == "seasons":
                    columns.append(pa.array(seasons[of]))
                elif kind == "count":
                    columns.append(pa.array(sums[of, place[state], m].astype(np.int64)))
                else:
                    n, total = sums[of, place[f"{state}__n"], m], sums[of, place[f"{state}__s"], m]
                    value = total if kind == "sum" else total / np.maximum(n, 1)
                    columns.append(pa.array(value, mask=n == 0))
            yield pa.record_batch([c if isinstance(c, pa.Array) else c.chunk(0) for c in columns],
                                  ["dt_ref", "driverid", *carry, *(c for c, *_ in made)])

    return rows.mapInArrow(run, ", ".join(schema))


def window_bounds(results: DataFrame, year_start: int | None, year_stop: int | None, windows: dict[str, int | None]) -> DataFrame:
    """Per reference date the key of the oldest round of each finite window; broadcast when its bound is proven."""
    finite = {w: n for w, n in windows.items() if n is not None}
    seen = asof.rounds_at_dates(results, year_start, year_stop).select("dt_ref", F.filter(
        "rounds", lambda r: r["year"].isNotNull() & r["roundnumber"].isNotNull()).alias("rounds"))
    oldest = lambda n: F.try_element_at("rounds", F.least(F.lit(n), F.greatest(F.size("rounds"), F.lit(1))))
    key = lambda r: r["year"].cast("long") * 4294967296 + r["roundnumber"]
    # where no round is seen nothing is in the window
    out = seen.select("dt_ref", *[F.coalesce(key(oldest(n)), F.lit(2 ** 63 - 1)).alias(f"from{w}") for w, n in finite.items()])
    return asof.maybe_broadcast(out, asof.date_bound(year_start, year_stop))
