"""Near-duplicate, embedding and substring operators against brute force."""

import collections
import hashlib
import itertools
import math
import random

import numpy as np
import oracle
import pyarrow as pa
import pytest

from asofstore.llm import common, embedding, minhash, substring
from asofstore.llm.queries import ORACLE, QUERIES
from conftest import SF_SMALL
from llm_cases import no_docs, odd_docs  # noqa: F401


def components(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute_minhash(docs, k, percent=80):
    sets = {i: shingles(t, k) for i, t in docs}
    inverse = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverse[x].append(i)
    links = []
    for i, s in sets.items():
        both = collections.Counter(j for x in s for j in inverse[x] if j > i)
        links += [(i, j) for j, m in both.items() if 100 * m >= percent * (len(s) + len(sets[j]) - m)]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


def near_copies(seed, groups=6, size=30, words=120):
    rng = random.Random(seed)
    out, n = [], 0
    for _ in range(groups):
        base = [f"v{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(9)):
                w[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
            out.append((n, " ".join(w)))
            n += 1
    rng.shuffle(out)
    return out


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("name", ["op2_embedding_near_dedup", "op3_substring_dedup", "op10_minhash_near_dedup"])
def test_query_equals_its_sql(spark, con, name):
    ok, message = oracle.compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, message


def test_minhash_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.read(spark, SF_SMALL, "documents").collect()]
    got = QUERIES["op10_minhash_near_dedup"](spark, SF_SMALL)
    assert found(got) == brute_minhash(docs, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_minhash_links_at_the_threshold_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    docs = near_copies(1)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), k=4)
    assert found(got) == brute_minhash(docs, 4)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
    sets = [a[:600], a[200:800], a[:1], a[:3], np.empty(0, np.uint64)]
    sk = minhash.fast_similarity_sketch(np.concatenate(sets), np.array(list(map(len, sets))))
    full = np.uint64(2 ** 64 - 1)
    assert (sk[:4] != full).all() and (sk[4] == full).all()
    assert abs((sk[0] == sk[1]).mean() - 0.5) < 5 * math.sqrt(0.25 / minhash.T)


def test_minhash_odd_rows(spark, odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs, k=4).collect()
    assert len(rows) == odd_docs.count()
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert by[1, 8] == (1, True) and by[8, 8] == (1, False)
    assert by[None, 8] == (None, True)
    assert by[7, 29_997] == (6, False)
    assert all(by[i, 0] == (i, True) for i in (2, 3, 4))
    assert by[10, 1] == (9, False)
    kept = minhash.deduplicate(odd_docs, k=4)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 9, 11]
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.deduplicate(no_docs).count() == 0


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500)]
    got = dict(map(tuple, common.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    links = [x for x in links if x[0] != x[1]]
    want = components({x for pair in links for x in pair}, links)
    assert got == want


def test_deduplicate_a_table_loaded_twice(spark, odd_docs):
    once = minhash.deduplicate(odd_docs.where("doc_id IS NOT NULL")).collect()
    assert len(once) == len({(r.doc_id, r.text) for r in once}) and {1, 2, 3, 5, 6, 11} <= {r.doc_id for r in once}
    twice = minhash.deduplicate(odd_docs.union(odd_docs))
    assert twice.columns == odd_docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in twice.collect())
    assert {x: n for x, n in got.items() if x[0] is not None} == {(r.doc_id, r.text): 1 for r in once}
    assert sum(n for (i, _), n in got.items() if i is None) == 2


# ------------------------------------------------------------------ embeddings

def brute_embedding(rows, threshold=0.9):
    good = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, n = [], collections.Counter()
    for (i, x), (j, y) in itertools.combinations(good, 2):
        if len(x) == len(y) and x @ y >= threshold:
            links.append((i, j))
            n[i] += 1
            n[j] += 1
    return {i: (n[i], c) for i, c in components({i for i, _ in rows}, links).items()}


def clusters(seed, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(12):
        base = rng.standard_normal(dim)
        for _ in range(25):
            out.append(base + rng.standard_normal(dim) * rng.uniform(0.05, 0.3))
    out += [out[0], out[0] * 3.0, -out[0]]
    return [(i, [float(x) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("block", [1024, 9])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding, "BLOCK", block)
    rows = clusters(5)
    got = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), miss=1e-6)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == brute_embedding(rows)


def test_embedding_recall_of_production_parameters(spark):
    rows = clusters(6)
    want = brute_embedding(rows)
    got = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    links = {r.vec_id: r.n_links for r in got.collect()}
    assert all(links[i] <= want[i][0] for i in links)           # no link below the threshold
    assert sum(links.values()) >= 0.95 * sum(n for n, _ in want.values())


@pytest.mark.parametrize("n", [10 ** 4, 10 ** 6, 10 ** 8])
def test_embedding_tables_miss_no_more_than_stated(n):
    dim, pairs = 64, 5000
    k, tables = embedding.plan_tables(n, 0.9, 0.005)
    rng = np.random.default_rng(n)
    x = embedding.unit(rng.standard_normal((pairs, dim)))
    other = rng.standard_normal((pairs, dim))
    other = embedding.unit(other - (other * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + math.sqrt(1 - 0.81) * other
    turn, chosen = embedding.rotation(dim).T, embedding.table_bits(dim, k, tables)
    met = (embedding.bucket_keys(x @ turn > 0, chosen, dim) == embedding.bucket_keys(y @ turn > 0, chosen, dim)).any(axis=1)
    assert (~met).mean() <= 0.005 + 3 * math.sqrt(0.005 / pairs)


def test_embedding_query_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in common.read(spark, SF_SMALL, "embeddings").collect()]
    got = QUERIES["op2_embedding_near_dedup"](spark, SF_SMALL).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute_embedding(rows)


def test_embedding_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    x = embedding.unit(rng.standard_normal((400, 64)))
    y = embedding.unit(x + 0.3 * rng.standard_normal((400, 64)))
    turned = x @ embedding.rotation(64).T
    c = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    est, bound = embedding.estimates((turned > 0).astype(np.uint8), c, (y @ embedding.rotation(64).T).astype(np.float32))
    error = est - x @ y.T
    assert abs(error.mean()) < 0.002
    assert (np.abs(error) <= bound[:, None]).mean() > 0.9999


def test_embedding_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.001]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]),
            (None, [1.0, 0.0]), (11, [1e-300, 1e-300]), (12, [1e300, 1e300]), (2, [1.0, 0.0]), (13, [-0.0, -1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, _rep string")
    got = collections.defaultdict(list)
    for r in embedding.near_duplicates(df, miss=1e-9).collect():
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] * 2 and got[3] == [(3, 1, False)]
    for i in (4, 5, 6, 7, 8, 9, 10, 13):
        assert got[i] == [(0, i, True)]
    assert got[11] == [(1, 11, True)] and got[12] == [(1, 11, False)]
    assert got[None] == [(0, None, True)]
    assert embedding.near_duplicates(df.where("false")).count() == 0


# ------------------------------------------------------------------- substring

def brute_substring(docs, window=50):
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in texts:
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, w in texts:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def cut(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_substring_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.read(spark, SF_SMALL, "documents").collect()]
    assert cut(QUERIES["op3_substring_dedup"](spark, SF_SMALL)) == brute_substring(docs)


def passages(seed):
    """Few words, shared passages of 45 to 80 words at odd places, copies of copies."""
    rng = random.Random(seed)
    text = lambda n: [f"t{rng.randrange(60)}" for _ in range(n)]
    shared = [text(rng.randrange(45, 80)) for _ in range(4)]
    docs = []
    for i in range(40):
        w = text(rng.randrange(0, 90))
        for p in rng.sample(shared, rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
        docs.append((i, " ".join(w)))
    docs.append((40, docs[3][1]))
    docs.append((41, "a " * 200))
    docs.append((42, "a " * 130 + "b"))
    return docs


@pytest.mark.parametrize("rows", [substring.GROUP_ROWS, 20, 2])
def test_substring_passages_whatever_the_group_size(spark, rows):
    docs = passages(4)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    scan, changed = substring.repeats(df, group_rows=rows)
    got = {r["_id"]: (r["_removed"], r["_kept"].decode()) for r in changed.collect()}
    for i, (n, removed, sha) in brute_substring(docs).items():
        kept = got[i][1] if i in got else " ".join(docs[i][1].split())
        assert (got.get(i, (0, ""))[0], hashlib.sha256(kept.encode()).hexdigest()) == (removed, sha)


def test_substring_trees_of_sorted_suffixes():
    """Depths and deep nodes of one group, batch by batch, against all pairs; words 0 and 9 share a letter."""
    rng, window = random.Random(8), 5
    text = {d: [rng.choice([0, 0, 1, 9]) for _ in range(40)] for d in range(12)}
    spelled = lambda w: bytes(b for x in w for b in (0, x % 9))
    rows = sorted((spelled(w[i:i + window]), hash(tuple(w[i:i + window])), d, i)
                  for d, w in text.items() for i in range(len(w) - window + 1))
    path, full, ids, pos = map(list, zip(*rows))
    letters = np.frombuffer(b"".join(path), ">u2").reshape(-1, window)
    depth = substring.common_words(letters[1:], letters[:-1], np.array(full[1:]), np.array(full[:-1]))
    for i, got in enumerate(depth):
        same = [a == b for a, b in zip(letters[i], letters[i + 1])] + [False]
        want = same.index(False)
        assert got == (want if want < window else window - (full[i] != full[i + 1]))
    table = pa.table({"_path": pa.array(path, pa.binary()), "_full": full, "_id": ids,
                      "_t": pa.array([0] * len(ids), pa.int32()), "_pos": pa.array(pos, pa.int32())})
    for size in (1, 7, 1000):
        found = pa.Table.from_batches(substring._subtrees(window)(table.to_batches(max_chunksize=size)))
        first = {}
        for d, w in text.items():
            for i in range(len(w) - window + 1):
                first.setdefault(tuple(w[i:i + window]), d)
        assert {(r["_id"], r["_pos"]) for r in found.to_pylist()} == {
            (d, i) for d, w in text.items() for i in range(len(w) - window + 1)
            if first[tuple(w[i:i + window])] < d}


def test_substring_frequent_prefix_in_many_continuations(spark):
    """Half of all suffixes begin alike and part later: the prefix is lengthened, nothing is lost."""
    rng = random.Random(5)
    docs = []
    for i in range(60):
        line = ["the"] * 30 + [f"p{rng.randrange(3)}" for _ in range(6)] + ["end"] * 25
        docs.append((i, " ".join([f"x{i}"] * 3 + line + [f"y{rng.randrange(9)}" for _ in range(20)])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute_substring(docs)
    for rows in (10, 200):
        scan, changed = substring.repeats(df, group_rows=rows)
        got = {r["_id"]: r["_removed"] for r in changed.collect()}
        assert {i: got.get(i, 0) for i, _ in docs} == {i: w[1] for i, w in want.items()}


def test_substring_odd_rows(spark, odd_docs, no_docs):
    got = collections.defaultdict(list)
    for r in substring.digests(odd_docs).collect():
        got[r.doc_id].append((r.n_words, r.n_removed))
    assert got[6] == [(30_000, 0)] and got[7] == [(30_000, 30_000)]
    assert got[2] == got[3] == got[4] == [(0, 0)] and got[8] == [(11, 0)] * 2 and got[None] == [(11, 0)]
    new = substring.remove_repeats(odd_docs)
    assert new.columns == odd_docs.columns and new.count() == odd_docs.count()
    text = {r.doc_id: r.text for r in new.collect()}
    assert text[7] == "" and text[2] is None and text[4] == " \n\t "
    assert substring.digests(no_docs).count() == 0 and substring.remove_repeats(no_docs).count() == 0


def test_substring_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (2, a)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed) for r in substring.digests(df).collect())
    assert got == [(1, 0), (2, 0), (2, 60), (2, 60)]
    assert sorted(r.text for r in substring.remove_repeats(df).where("doc_id = 2").collect()) == ["", "", b]
