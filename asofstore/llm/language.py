"""Multilingual mixture inference (operator 1).

A document's bytes (lower case, without digits, punctuation and line breaks)
are taken as 3-byte grams, each drawn from one of the languages: expectation
maximisation estimates the document's language proportions from the grams'
likelihoods under each language. The language set is selected by penalised
likelihood: starting from the single best language, a language joins if the
gain in log-likelihood exceeds ``penalty`` times half the logarithm of the
number of grams (neighbouring 3-grams share two bytes, so the likelihood is
divided by 3 before it is compared).

**Model.** Counts of hashed grams per language from a bounded sample of
labelled documents: ``sample`` per language on average (parameter, at most
``MAX_LANGUAGES`` languages). The model is ``languages x 65,536`` numbers and is
all that is broadcast. Counting is distributed and pre-aggregated per task.

Defined results: ``und`` with score 0 and no languages for text that is null or
has no letter, and for every text if there is nothing to learn from; grams that
no language has seen weigh the same for all; equal likelihoods are resolved by
the language's name; extra columns are carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BINS = 1 << 16
MAX_LANGUAGES = 512
OVERLAP = 3
_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c) if (65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32
               for c in range(256))


def grams(text: str) -> np.ndarray:
    """Bins of the 3-byte grams, those of nothing but spaces left out."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_CLEAN) + b" ", np.uint8)
    x = b.astype(np.uint32)
    code = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    code = code[(b[1:-1] != 32)]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray           # languages x BINS
    penalty: float = 4.0

    def infer(self, text: str | None) -> list[tuple[str, float]]:
        """Selected languages with their shares, the largest first."""
        if not self.languages or not has_letter(text):
            return []
        bins, count = np.unique(grams(text), return_counts=True)
        log_p = self.log_p[:, bins]
        n = count.sum()
        single = log_p @ count
        chosen = [int(single.argmax())]
        share = np.ones(1)
        best = single[chosen[0]]
        p = np.exp(log_p - log_p.max(axis=0))           # a factor per gram cancels out
        shift = log_p.max(axis=0) @ count
        cost = self.penalty * 0.5 * np.log(max(n / OVERLAP, 2))
        while len(chosen) < len(self.languages):
            mixed = share @ p[chosen]
            slope = (p / np.maximum(mixed, 1e-300)) @ count / n
            slope[chosen] = 0
            gain, found = 0.0, None
            for l in np.argsort(-slope, kind="stable")[:3]:
                if slope[l] <= 1:       # likelihood falls from the first step towards it
                    break
                w, ll = self._em(p[[*chosen, l]], count, n, np.append(share * 0.9, 0.1))
                if (ll + shift - best) / OVERLAP - cost > gain:
                    gain, found = (ll + shift - best) / OVERLAP - cost, (int(l), w, ll + shift)
            if found is None:
                break
            chosen.append(found[0])
            share, best = found[1], found[2]
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.languages[chosen[i]]))
        return [(self.languages[chosen[i]], float(share[i])) for i in order]

    @staticmethod
    def _em(p: np.ndarray, count: np.ndarray, n: int, w: np.ndarray, steps: int = 40) -> tuple[np.ndarray, float]:
        for _ in range(steps):
            part = w[:, None] * p
            new = (part / np.maximum(part.sum(axis=0), 1e-300)) @ count / n
            moved = np.abs(new - w).max()
            w = new
            if moved < 1e-3:
                break
        return w, float(np.log(np.maximum(w @ p, 1e-300)) @ count)


# ------------------------------------------------------------------- training

def fit(docs: DataFrame, usable: Column, sample: int = 4000, text_col: str = "text",
        lang_col: str = "lang", id_col: str = "doc_id", penalty: float = 4.0) -> Model:
    """A model from the rows where ``usable`` holds and lang is not null."""
    known = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    n = {r[0]: r[1] for r in known.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(n) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    if not n:
        return Model([], np.empty((0, BINS)), penalty)
    draw = (F.xxhash64(F.col(id_col), F.lit("fit")) / F.lit(2.0 ** 63) + 1) / 2
    rate = F.create_map(*[F.lit(x) for l, c in n.items() for x in (l, float(sample) / c)])
    src = (known.where(draw < F.element_at(rate, F.col(lang_col)))
           .select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in C.slices(batches):
            for l, t in zip(b.column("_lang").to_pylist(), b.column("_text").to_pylist()):
                if l not in total:
                    total[l] = np.zeros(BINS, np.int64)
                total[l] += np.bincount(grams(t), minlength=BINS)
        for l, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(at)), pa.array(at), pa.array(c[at])],
                                             names=["_lang", "_bin", "_n"])
    counts = (src.mapInArrow(count, "_lang string, _bin bigint, _n bigint")
              .groupBy("_lang", "_bin").agg(F.sum("_n").alias("_n")).toArrow())
    languages = sorted(set(counts.column("_lang").to_pylist()))
    table = np.full((len(languages), BINS), 0.5)
    row = {l: i for i, l in enumerate(languages)}
    if languages:
        table[[row[l] for l in counts.column("_lang").to_pylist()], counts.column("_bin").to_numpy()] += \
            counts.column("_n").to_numpy()
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)), penalty)


# ------------------------------------------------------------------ inference

NEW = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score (share of that language) and languages;
    columns of these names are replaced."""
    new = ["lang_pred", "score", "languages"]
    rest = [c for c in docs.columns if c not in new and (keep_text or c != text_col)]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    C.small_batches(docs.sparkSession)

    def run(batches):
        m = shared.value
        for b in C.slices(batches):
            got = [m.infer(t) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array([g[0][0] if g else "und" for g in got], pa.string()),
                 pa.array([min(g[0][1], 1.0) if g else 0.0 for g in got], pa.float64()),
                 pa.array([[{"lang": l, "share": s} for l, s in g] for g in got],
                          pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=[*rest, *new])
    return docs.select(*rest, *([] if keep_text else [text_col])).mapInArrow(run, (kinds + ", " if kinds else "") + NEW)
