"""Substring deduplication with prefix-partitioned suffix trees (operator 3).

A repeat is a run of at least ``window`` words whose word sequence also starts
in a document with a smaller id. Finding it means finding the deep internal
nodes (word depth >= ``window``) of the generalised suffix tree of all
documents. The tree is never built whole:

1. **Which suffixes can reach a deep node.** The smallest 10-word gram of a
   window is the same wherever the window occurs, so a suffix whose smallest
   gram (a *mark*) occurs in one document only has no deep node above it.
   Consecutive suffixes with one mark form a *run*; runs, not suffixes, are
   exchanged to find the marks that several documents share. Runs equal in
   their whole text are one node path and are settled as a unit.
2. **Prefix partitioning.** Each remaining suffix is cut to its first ``window``
   words, spelled in an alphabet of 65,536 letters (16 bits of each word's hash).
   Suffixes are dealt out by a prefix of variable length: ``STEP`` words at first;
   a prefix that more than ``group_rows`` suffixes share is made twice as long,
   again and again, until its groups fit in memory. Nodes that are larger than a
   group even at depth ``window`` are not gathered: their smallest document comes
   from an aggregate with map-side combining.
3. **Subtrees.** A group's suffixes are sorted by their words' letters; the common
   prefix of neighbours gives the depth of the node that joins them. The tree is
   cut at depth ``window``, so a deep internal node has leaves for children and is
   a stretch of neighbours that agree to this depth: in every letter, and in a
   64-bit hash of the words, as two words may share a letter. The node's first document
   owns the sequence; its other suffixes are repeats. A longer repeat is a chain of
   deep nodes (its windows), and :func:`_cutter` joins what they cover to the
   maximal spans that are removed.

A document that is settled whole (a copy) needs no text any more.

Defined results: null or empty text has no words; rows that share a doc_id are
one document (equal text in one document is no repeat of itself); a null doc_id
is compared with nothing; a text with fewer words than ``window`` is unchanged;
extra columns are carried by :func:`remove_repeats` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

GRAM = 10
STEP = 4                    # words of the shortest prefix
GROUP_ROWS = 200_000
SUFFIX_BATCH = 20_000       # suffixes that a task holds spelled out
MAX_FREQUENT = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

SCAN = ("_id bigint, _t int, _n bigint, _sha binary, "
        "_mark array<bigint>, _start array<int>, _content array<bigint>")
SPANS = "array<struct<start:int,len:int>>"


class Stretches:
    """Hashes of any stretch of a word sequence from prefix sums."""

    INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

    def __init__(self, w: np.ndarray):
        up = np.full(len(w) + 1, BASE, np.uint64)
        down = np.full(len(w) + 1, self.INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.total = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(w * np.cumprod(up, dtype=np.uint64)[:-1], out=self.total[1:], dtype=np.uint64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sum of w[i] * BASE^(i - start), mixed with the length."""
        length = (end - start).astype(np.uint64)
        return C.mix((self.total[end] - self.total[start]) * self.down[start] + length * C.GOLDEN)


def marks_of(w: np.ndarray, window: int) -> np.ndarray:
    """For each window of ``window`` words the smallest of its gram hashes."""
    low = C.gram_hashes(w, GRAM)
    width = window - GRAM + 1
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    return low


def runs_of(w: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mark, start, content hash) of the runs of windows with one mark."""
    if len(w) < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    mark = marks_of(w, window)
    start = np.concatenate([[0], np.flatnonzero(mark[1:] != mark[:-1]) + 1])
    end = np.append(start[1:], len(mark)) + window - 1      # of the words that the run covers
    return mark[start], start, Stretches(w)(start, end)


def _scanner(window: int):
    def run(batches):
        C._WORDS.use()
        for b in C.slices(batches):
            rows, mark, start, content = [], [], [], []
            for t in b.column("_text").to_pylist():
                words = C.words_of(t)
                m, s, c = runs_of(C.hash_words(words), window)
                rows.append((len(words), hashlib.sha256(b" ".join(words)).digest(), len(m)))
                mark.append(m), start.append(s), content.append(c)
            n, sha, runs = zip(*rows)
            runs = np.array(runs)
            yield pa.RecordBatch.from_arrays([
                b.column("_id"), b.column("_t"), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                C.list_array(np.concatenate(mark).view(np.int64), runs, pa.int64()),
                C.list_array(np.concatenate(start).astype(np.int32), runs, pa.int32()),
                C.list_array(np.concatenate(content).view(np.int64), runs, pa.int64())],
                names=["_id", "_t", "_n", "_sha", "_mark", "_start", "_content"])
    return run


# ------------------------------------------------------------- suffix groups

def _suffixes(window: int):
    """The suffixes that begin in the wanted runs, cut to ``window`` words."""
    def batch(rows):
        ids, keys, pos, path, full = (np.concatenate(x) for x in zip(*rows))
        ends = np.arange(len(ids) + 1, dtype=np.int32) * (2 * window)
        return pa.RecordBatch.from_arrays(
            [C.long_array(ids), pa.array(keys), pa.array(pos),
             pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(path.tobytes())]),
             C.long_array(full)], names=["_id", "_t", "_pos", "_path", "_full"])

    def run(batches):
        rows, held = [], 0
        for b in C.slices(batches, 500):
            for i, k, t, spans in zip(*(b.column(c).to_pylist() for c in ("_id", "_t", "_text", "_runs"))):
                words = C.hash_words(C.words_of(t))
                hashed = Stretches(words)
                paths = np.lib.stride_tricks.sliding_window_view((words >> np.uint64(48)).astype(">u2"), window)
                starts = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["len"]) for s in spans]))
                for p in range(0, len(starts), SUFFIX_BATCH):
                    at = starts[p:p + SUFFIX_BATCH]
                    rows.append((np.full(len(at), i, np.int64), np.full(len(at), k, np.int32), at.astype(np.int32),
                                 paths[at], hashed(at, at + window)))
                    held += len(at)
                    if held >= SUFFIX_BATCH:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)
    return run


def common_words(path: np.ndarray, before: np.ndarray, full: np.ndarray, full_before: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it, up to the depth of the tree."""
    window = path.shape[1]
    differ = path != before
    to_the_end = np.where(full == full_before, window, window - 1)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), to_the_end)


def _subtrees(window: int):
    """Repeats below the deep nodes of sorted suffixes.

    The leaves of a node come ordered by document, so its owner is the first one
    and memory does not grow with the node.
    """
    def run(batches):
        last, last_full, owner = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            path, full = C.bytes_matrix(b.column("_path"), np.uint16), b.column("_full").to_numpy()
            ids = b.column("_id").to_numpy()
            if last is None:            # no suffix comes before the first one
                last, last_full = ~path[0], full[0]
            depth = common_words(path, np.vstack([last, path[:-1]]), full, np.append(last_full, full[:-1]))
            first = np.maximum.accumulate(np.where(depth < window, np.arange(b.num_rows), -1))
            own = np.where(first >= 0, ids[np.maximum(first, 0)], owner)
            last, last_full, owner = path[-1], full[-1], own[-1]
            rep = pa.array(own < ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(c).filter(rep) for c in ("_id", "_t", "_pos")], names=["_id", "_t", "_pos"])
    return run


def deep_repeats(suffixes: DataFrame, window: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(_id, _t, _pos) of suffixes whose first ``window`` words also begin a
    suffix of a document with a smaller id.

    At most ``rows / group_rows`` prefixes are frequent; their table is joined
    to the suffixes by broadcast while it has fewer than ``MAX_FREQUENT`` rows.
    """
    def prefix(words):
        return F.substring("_path", 1, 2 * words)

    def counted(table):
        n = table.count()
        return n, F.broadcast(table) if n < MAX_FREQUENT else table

    words, at = min(STEP, window), ["_id", "_t", "_pos"]
    dealt, below, huge = suffixes.withColumn("_group", prefix(words)), suffixes, None
    while words < window:
        n, frequent = counted(C.stage(below.groupBy(prefix(words).alias("_prefix")).agg(F.count("*").alias("_c"))
                                      .where(f"_c > {int(group_rows)}").select("_prefix"), "substring-frequent"))
        if not n:
            break
        below = below.join(frequent, prefix(words) == F.col("_prefix"), "left_semi")
        words = min(2 * words, window)
        dealt = (dealt.join(frequent, F.col("_group") == F.col("_prefix"), "left")
                 .withColumn("_group", F.when(F.col("_prefix").isNotNull(), prefix(words)).otherwise(F.col("_group")))
                 .drop("_prefix"))
    else:       # some groups are as deep as the tree: nodes larger than a group
        node = ["_path", "_full"]
        n, owned = counted(C.stage(below.groupBy(*node).agg(F.count("*").alias("_c"), F.min("_id").alias("_lo"))
                                   .where(f"_c > {int(group_rows)}").select(*node, "_lo"), "substring-nodes"))
        if n:
            dealt = dealt.join(owned, node, "left")
            huge = dealt.where("_lo < _id").select(*at)
            dealt = dealt.where("_lo IS NULL")
    found = (dealt.repartition("_group").sortWithinPartitions("_path", "_full", "_id")
             .select("_path", "_full", *at).mapInArrow(_subtrees(window), "_id bigint, _t int, _pos int"))
    return found if huge is None else found.union(huge)


# ------------------------------------------------------------------ operator

def _cutter(window: int):
    def run(batches):
        for b in C.slices(batches, 500):
            removed, texts, shas, where = [], [], [], []
            for t, spans in zip(b.column("_text").to_pylist(), b.column("_spans").to_pylist()):
                words = C.words_of(t)
                gone = np.zeros(len(words) + 1, np.int32)
                for s in spans:
                    gone[s["start"]] += 1
                    gone[s["start"] + s["len"] + window - 1] -= 1
                cover = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]]).astype(np.int8)))
                kept = b" ".join([words[i] for i in np.flatnonzero(~cover)])
                removed.append(int(cover.sum()))
                texts.append(kept)
                shas.append(hashlib.sha256(kept).digest())
                where.append([{"start": int(s), "len": int(e - s)} for s, e in edge.reshape(-1, 2)])
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_t"), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()),
                 pa.array(shas, pa.binary()), pa.array(where, pa.list_(pa.struct([("start", pa.int32()),
                                                                                  ("len", pa.int32())])))],
                names=["_id", "_t", "_removed", "_kept", "_sha", "_spans"])
    return run


def repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
            group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(scan, cut): one row per document row with its word count and digest,
    and one row per changed text with removed words, kept text, its digest and
    the removed spans (maximal repeats, in words). Rows are found again by
    ``_id`` and ``_t``, a hash of the text, so that rows may share a doc_id."""
    if window < GRAM:
        raise ValueError(f"window must have {GRAM} words at least")
    C.small_batches(docs.sparkSession)
    src = _source(docs, id_col, text_col)
    scan = C.stage(src.mapInArrow(_scanner(window), SCAN), "substring-scan")
    at = ["_id", "_t"]
    runs = (scan.where("_id IS NOT NULL")
            .select(*at, "_n", F.posexplode("_mark").alias("_i", "_m"), "_start", "_content")
            .withColumn("_begin", F.element_at("_start", F.col("_i") + 1))
            .select(*at, F.col("_m").alias("_mark"), F.element_at("_content", F.col("_i") + 1).alias("_content"),
                    "_begin", (F.coalesce(F.try_element_at("_start", F.col("_i") + 2),
                                          (F.col("_n") - window + 1).cast("int")) - F.col("_begin")).alias("_len")))

    # runs whose mark several documents share
    shared = (runs.groupBy("_mark").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
              .where("_lo < _hi").select("_mark"))
    runs = C.stage(runs.join(shared, "_mark"), "substring-runs")
    # equal runs are settled by their first document; a mark is open where runs
    # of several first documents share it
    equal = runs.groupBy("_mark", "_content", "_len").agg(F.min("_id").alias("_own"))
    owned = C.stage(runs.join(equal, ["_mark", "_content", "_len"]).drop("_content"), "substring-owned")
    C.unstage(runs)
    run = F.struct(F.col("_begin").alias("start"), F.col("_len").alias("len"))
    open_marks = (owned.groupBy("_mark").agg(F.min("_own").alias("_lo"), F.max("_own").alias("_hi"))
                  .where("_lo < _hi").select("_mark"))
    wanted = (owned.where("_own = _id").join(open_marks, "_mark").groupBy(*at).agg(F.collect_list(run).alias("_runs")))
    settled = C.stage(owned.where("_own < _id").groupBy(*at).agg(
        F.collect_list(run).alias("_settled"), F.sum("_len").alias("_covered")), "substring-settled")

    # the texts that take part, once; a text that is settled whole needs none
    whole = scan.join(settled, at).where(f"_covered >= _n - {window - 1}").select(*at, F.col("_n").alias("_whole"))
    whole = C.stage(whole.distinct(), "substring-whole")
    part = wanted.join(settled.join(whole, at, "left_anti").select(*at, "_settled"), at, "full")
    texts = C.stage(src.join(part, at), "substring-texts")
    C.unstage(owned, settled)
    suffixes = C.stage(texts.where("_runs IS NOT NULL").mapInArrow(
        _suffixes(window), "_id bigint, _t int, _pos int, _path binary, _full bigint"), "substring-suffixes")
    found = C.stage(deep_repeats(suffixes, window, group_rows).groupBy(*at)
                    .agg(F.collect_list("_pos").alias("_found")), "substring-found")
    C.unstage(suffixes)
    spans = F.concat(F.coalesce("_settled", F.array().cast(SPANS)), F.coalesce(F.transform(
        "_found", lambda x: F.struct(x.alias("start"), F.lit(1).alias("len"))), F.array().cast(SPANS)))
    cut = (texts.join(found, at, "left").where("_settled IS NOT NULL OR _found IS NOT NULL")
           .select(*at, "_text", spans.alias("_spans"))
           .mapInArrow(_cutter(window),
                       f"_id bigint, _t int, _removed bigint, _kept binary, _sha binary, _spans {SPANS}"))
    gone = whole.select(*at, F.col("_whole").alias("_removed"), F.lit(b"").alias("_kept"),
                        F.unhex(F.sha2(F.lit(""), 256)).alias("_sha"),
                        F.array(F.struct(F.lit(0).alias("start"), F.col("_whole").cast("int").alias("len"))).alias("_spans"))
    return scan, cut.union(gone)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.hash(F.col(text_col)).alias("_t"),
                       F.col(text_col).cast("binary").alias("_text"))


def digests(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row of ``docs``."""
    scan, cut = repeats(docs, window, id_col, text_col)
    done = cut.select("_id", "_t", "_removed", F.col("_sha").alias("_cut")).dropDuplicates(["_id", "_t"])
    return (scan.select("_id", "_t", "_n", "_sha").join(done, ["_id", "_t"], "left")
            .select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_words"),
                    F.coalesce("_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.lower(F.hex(F.coalesce("_cut", "_sha"))).alias("kept_sha256")))


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeats cut from the text (kept words joined by one
    space); texts without repeats are unchanged, texts that are nothing but
    repeats become empty."""
    _, cut = repeats(docs, window, id_col, text_col)
    done = (cut.select("_id", "_t", F.col("_kept").cast("string")).dropDuplicates(["_id", "_t"])
            .toDF("__cut_id", "__cut_hash", "__cut_text"))
    joined = docs.join(done, (F.col(id_col).cast("long") == F.col("__cut_id"))
                       & (F.hash(F.col(text_col)) == F.col("__cut_hash")), "left")
    return joined.select(*[F.coalesce("__cut_text", F.col(c)).alias(c) if c == text_col else F.col(c)
                           for c in docs.columns])
