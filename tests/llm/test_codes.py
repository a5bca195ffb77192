"""Operator 11: equal-average search and product codes against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from asofstore.llm import codes

KIND = "vec_id bigint, embedding array<float>, label int, code string, error string, _q int, _key int"


def brute(rows, parts, entries, rounds, scale=4096):
    """(id, code, error) per kept row, label totals and codebooks, every part against every entry."""
    kept = sorted(((r[0], r[2], [int(np.floor(np.float64(x) * scale)) for x in r[1]]) for r in rows
                   if r[1] and all(x is not None and np.isfinite(x) for x in r[1])),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    x = np.array([r[2] for r in kept], dtype=object).reshape(len(kept), parts, -1)
    books = [[list(v[p]) for v in x[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            member = [nearest(p, v[p])[1] for v in x]
            for e in range(len(books[p])):
                mine = [v[p] for v, m in zip(x, member) if m == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for (i, label, _), v in zip(kept, x):
        best = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), code, error, total[label], digest) for i, code, error, label in out)


def got(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 6), st.randoms())
def test_search_finds_the_nearest_entry_and_the_lower_of_ties(k, d, random):
    entries = np.array([[random.randint(-3, 3) for _ in range(d)] for _ in range(k)])
    x = np.array([[random.randint(-4, 4) for _ in range(d)] for _ in range(40)])
    code, dist, compared = codes.SortedBook(entries).nearest(x)
    every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
    assert len(x) <= compared <= len(x) * k


def test_search_leaves_out_entries_whose_sum_is_too_far():
    entries = np.arange(100)[:, None] * np.ones((1, 4), np.int64) * 1000
    _, _, compared = codes.SortedBook(entries).nearest(entries[[3, 50, 97]] + 1)
    assert compared == 3


def test_stop_is_strict():
    # both entries are 4 away; the sum gap squared over d equals the best distance, and index 0 wins
    code, dist, _ = codes.SortedBook(np.array([[2], [-2]])).nearest(np.array([[0]]))
    assert code[0] == 0 and dist[0] == 4
    code, _, _ = codes.SortedBook(np.array([[-2], [2]])).nearest(np.array([[0]]))
    assert code[0] == 0


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, 0.3, 4).astype(np.float32)], i % 3 or None) for i in range(40)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan"), 0.0, 0.0, 0.0], 2),
             (103, [float("inf"), 0.0, 0.0, 0.0], 2), (104, [], 2), (None, [0.5, -0.5, 0.25, 0.0], None),
             (7, [0.0, -0.0, 0.0, -1e-9], 5), (7, [0.0, -0.0, 0.0, -1e-9], 5), (8, [1.0, 1.0, 1.0, 1.0], 5)]
    return rows


@pytest.mark.parametrize("parts,entries,rounds", [(2, 4, 3), (4, 16, 6), (1, 256, 2)])
def test_codes_equal_brute_force(spark, parts, entries, rounds):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in rows], KIND)
    assert got(codes.compress(df, parts=parts, entries=entries, rounds=rounds)) == brute(rows, parts, entries, rounds)


def test_result_does_not_depend_on_the_partitioning(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert got(codes.compress(df.repartition(1))) == got(codes.compress(df.repartition(13)))


def test_vectors_of_another_length_go_and_bad_lengths_are_errors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [0.0, 2.0], 0), (3, [5.0], 0)],
                               "vec_id bigint, embedding array<double>, label int")
    assert {r["vec_id"] for r in codes.compress(df, parts=2).collect()} == {1, 2}
    with pytest.raises(ValueError, match="cannot be cut"):
        codes.compress(df, parts=3)


def test_no_rows_and_salted_labels(spark, monkeypatch):
    df = spark.createDataFrame(odd_rows(), "vec_id bigint, embedding array<float>, label int")
    assert got(codes.compress(df.where("false"), parts=2)) == []
    whole = got(codes.compress(df, parts=2))
    plain = codes.keyed_join
    monkeypatch.setattr(codes, "keyed_join", lambda *a: plain(*a, most=0, salts=3))
    assert got(codes.compress(df, parts=2)) == whole
