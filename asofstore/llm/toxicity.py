"""Toxicity by compression distance with zstandard dictionaries (operator 6).

A text is split into windows of ``window`` words. A word is written as two
96-bit codes, of its first ``STEM`` letters and of the whole word, so that a
dictionary matches beginnings and words and never chance letter sequences. Two dictionaries are trained by zstandard on whole texts of the
training documents, with all their words: an ordinary one on ordinary texts,
and a toxic one on what the ordinary one leaves uncompressed of the toxic texts.
A window's distance is its compressed length with the ordinary dictionary less
that with both: what knowing toxic wording saves beyond knowing ordinary
wording. The distances of a document's windows, from a calibrated threshold on,
are summed, and a logistic curve over that sum and the number of windows turns
them into a score, so that the same wording weighs less in a longer text.

**Training** uses a bounded sample: about ``sample`` toxic and three times as
many ordinary documents (parameter), of at most ``longest`` bytes each. A code
counts once per document, so neither copies of a line nor one long text weigh
much. No word is listed, chosen or left out by its label: which ones a
dictionary holds is up to zstandard's training, and its size decides how common
ordinary wording must be to be held. Sizes, threshold and curve are calibrated
out of fold: dictionaries of one half of the sample measure the other half.
Everything else covers whole texts of all rows.

Defined results: null or empty text has no windows and gets the score of a
document without toxic windows; without usable training rows of both classes
every score is 0; a null doc_id is never used for training and is scored;
labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

CODE = 12   # bytes; much longer than what a match costs
STEM = 4    # letters
# begins every window and ends every dictionary: one match that pays for a compressed block, without which
# zstandard would store a window as it is and a single matched word would save nothing
OPENER = xxhash.xxh3_128_digest(b"\0") * 4
ORDINARY = (64, 2048, 16384, 131072)    # dictionary sizes that are tried, in codes
TOXIC = (32, 256)
THRESHOLDS = (2, 4, 6, 8, 12)           # bytes
TRIED_ON, MEASURED = 200, 1000          # toxic documents that sizes are chosen by, and threshold and curve
_SPACED = bytes((c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
                else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split() if text else []


def units(word: bytes) -> list[bytes]:
    """Codes of a word's beginning, if it is longer, and of the word."""
    stem = word[:STEM] if word.isascii() else word.decode("utf-8", "replace")[:STEM].encode()
    return [xxhash.xxh3_128_digest(u)[:CODE] for u in ([stem, word] if stem != word else [word])]


class Codes(C.Remembered):
    """Codes of each word, joined."""

    def make(self, word: bytes) -> bytes:
        return b"".join(units(word))

    def windows(self, text: str | None, size: int) -> list[bytes]:
        codes = list(map(self.__getitem__, words(text)))
        return [OPENER + b"".join(codes[i:i + size]) for i in range(0, len(codes), size)]


_CODES = Codes()    # one per Python worker; it outlives a task


@dataclass
class Model:
    toxic: bytes                    # dictionary contents; empty: no model
    ordinary: bytes
    window: int
    threshold: int                  # least distance of a toxic window
    weights: np.ndarray

    def scorer(self):
        if not self.toxic:
            return lambda text: (0.0, 0, 0)
        far, near, codes = _compressor(self.ordinary), _compressor(self.ordinary + self.toxic), _CODES.use()

        def score(text: str | None) -> tuple[float, int, int]:
            found = distances(codes.windows(text, self.window), near, far)
            hits = [d for d in found if d >= self.threshold]
            z = float(self.weights @ _features(sum(hits), len(found)))
            return 1 / (1 + math.exp(-max(-500.0, z))), len(hits), len(found)
        return score


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    content += OPENER + bytes(CODE)     # a compressor does not index a dictionary's last bytes
    bits = max(12, len(content).bit_length())
    params = zstd.ZstdCompressionParameters(
        window_log=bits + 1, hash_log=bits, chain_log=bits, search_log=4, min_match=5, strategy=zstd.STRATEGY_GREEDY,
        write_content_size=0, write_checksum=0, write_dict_id=0)
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=d, compression_params=params)


def distances(windows: list[bytes], near: zstd.ZstdCompressor, far: zstd.ZstdCompressor) -> list[int]:
    return [len(far.compress(w)) - len(near.compress(w)) for w in windows]


# ------------------------------------------------------------------- training

Document = list[bytes]      # codes, each once, in order


def _dictionary(docs: list[Document], size: int) -> bytes:
    """A dictionary of about ``size`` codes trained on the documents; all their
    codes where they have no more, the most shared ones where there are too few
    documents to train on.

    Training goes through the sample stretch by stretch and cuts off, for its
    header, the segments that it chose first; what it lacks of the most shared
    codes, an eighth of the size, is put back.
    """
    kinds = Counter(c for d in docs for c in d)
    shared = sorted(kinds, key=lambda c: (-kinds[c], c))[:size]
    content = b""
    if len(kinds) > size:
        try:
            content = zstd.train_dictionary(CODE * size, [b"".join(d) for d in docs if d], k=CODE, d=8).as_bytes()
        except zstd.ZstdError:
            pass
    held = _held(content)
    return content + b"".join(c for c in (shared[:32 + size // 8] if content else shared) if c not in held)


def _held(content: bytes) -> set[bytes]:
    return {content[i:i + CODE] for i in range(len(content) - CODE + 1)}


def _rest(docs: list[Document], content: bytes) -> list[Document]:
    """What a dictionary does not hold of the documents."""
    held = _held(content)
    return [[c for c in d if c not in held] for d in docs]


def _features(gain: int, windows: int) -> tuple[float, float, float]:
    """Inputs of the curve; a document without toxic windows is one at any length."""
    return (1.0, math.log1p(gain), math.log1p(windows)) if gain else (1.0, 0.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, mean loss) of a logistic fit with a small ridge, by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -500, 500))), 1e-9, 1 - 1e-9)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _curves(lengths: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> list[tuple[float, int, np.ndarray]]:
    """(loss, threshold, weights) per threshold from each document's lengths
    (far, near) of its windows."""
    out = []
    for k in THRESHOLDS:
        gains = [np.maximum(far - near, 0) for far, near in lengths]
        x = np.array([_features(g[g >= k].sum(), len(g)) for g in gains])
        w, loss = _logistic(x, y)
        out.append((loss, k, w))
    return out


def fit(toxic: list[str], ordinary: list[str], window: int = 16) -> Model:
    """Dictionaries, window threshold and score curve from labelled texts."""
    key = lambda t: xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))
    texts = [sorted({t for t in side if words(t)}, key=lambda t: (key(t), t)) for side in (toxic, ordinary)]
    if not all(texts):
        return Model(b"", b"", window, 0, np.zeros(3))
    _CODES.use()
    docs = [[list(dict.fromkeys(u for w in dict.fromkeys(words(t)) for u in units(w))) for t in side] for side in texts]

    def measured(sizes_o, sizes_t, most: int) -> dict[tuple[int, int], tuple[list, np.ndarray]]:
        """Per pair of sizes the lengths (far, near) of the windows of up to
        ``most`` toxic and ``3 * most`` ordinary documents, and their labels."""
        out = {(m, n): ([], []) for m in sizes_o for n in sizes_t}
        for fold in (0, 1):
            train = [side[1 - fold::2] or side for side in docs]
            held = [(y, [_CODES.windows(t, window) for t in side[fold::2][:-(-most * (3 - 2 * y) // 2)]])
                    for y, side in ((1, texts[0]), (0, texts[1]))]
            for m in sizes_o:
                plain = _dictionary(train[1], m)
                rest, far = _rest(train[0], plain), _compressor(plain)
                base = [[np.array([len(far.compress(w)) for w in t]) for t in ws] for _, ws in held]
                for n in sizes_t:
                    near = _compressor(plain + _dictionary(rest, n))
                    rows, labels = out[m, n]
                    for (y, ws), lengths in zip(held, base):
                        rows += [(f, np.array([len(near.compress(w)) for w in t])) for f, t in zip(lengths, ws)]
                        labels += [y] * len(ws)
        return {k: (rows, np.array(labels, float)) for k, (rows, labels) in out.items()}

    tried = measured(ORDINARY, TOXIC, TRIED_ON)
    m, n = min(itertools.product(ORDINARY, TOXIC), key=lambda s: min(c[0] for c in _curves(*tried[s])))
    _, threshold, weights = min(_curves(*measured((m,), (n,), MEASURED)[m, n]), key=lambda c: c[:2])
    plain = _dictionary(docs[1], m)
    return Model(_dictionary(_rest(docs[0], plain), n), plain, window, threshold, weights)


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, sample: int, longest: int,
                    id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> tuple[list[str], list[str]]:
    """About ``sample`` toxic and ``3 * sample`` ordinary texts, at most twice as
    many, drawn by a hash of the id.

    The ids are drawn from the labels first; their number is bounded by
    ``8 * sample``, so they are broadcast and only their texts leave the scan.
    """
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & usable)
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_y")))
    n = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    draw = (F.xxhash64("_id") / F.lit(2.0 ** 63) + 1) / 2
    ids = None
    for y, total in n.items():
        most = sample * (1 if y else 3)
        one = known.where((F.col("_y") == y) & (draw < min(1.0, most / total))).limit(2 * most)
        ids = one if ids is None else ids.union(one)
    if ids is None:
        return [], []
    rows = (docs.where(F.octet_length(text_col) <= longest)
            .join(F.broadcast(ids), F.col(id_col).cast("long") == F.col("_id"))
            .select("_y", F.col(text_col).alias("_text")).collect())
    return [r["_text"] for r in rows if r["_y"] == 1], [r["_text"] for r in rows if r["_y"] == 0]


# ------------------------------------------------------------------- scoring

def score(docs: DataFrame, model: Model, cut: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with score, predicted, toxic_windows and n_windows in place of
    the text; columns of these names are replaced."""
    new = ("score", "predicted", "toxic_windows", "n_windows")
    rest = [c for c in docs.columns if c != text_col and c not in new]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    C.small_batches(docs.sparkSession)

    def run(batches):
        scorer = shared.value.scorer()
        for b in C.slices(batches):
            got = [scorer(t) for t in b.column(text_col).to_pylist()]
            s, hits, n = zip(*got)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array(s, pa.float64()),
                 pa.array([int(x >= cut) for x in s], pa.int32()), pa.array(hits, pa.int64()), pa.array(n, pa.int64())],
                names=[*rest, *new])
    return docs.select(*rest, text_col).mapInArrow(
        run, (kinds + ", " if kinds else "") + "score double, predicted int, toxic_windows bigint, n_windows bigint")
