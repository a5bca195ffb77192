"""Language and toxicity operators: held-out accuracy and odd rows."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from asofstore.llm import common, language, toxicity
from asofstore.llm.queries import QUERIES
from llm_cases import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in common.read(spark, SF, "documents").select("doc_id", "lang").collect()}
    got = QUERIES["op1_language_mixture"](spark, SF).collect()
    assert len(got) == len(lang) and all(r.held_out == (fold(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(common.read(spark, SF, "documents"), F.lit(True))


def test_language_mixtures_are_found(spark, model):
    docs = common.read(spark, SF, "documents").where("length(text) between 1500 and 4000").collect()
    one = {l: next(r.text for r in docs if r.lang == l) for l in model.languages}
    for a in one:
        assert [l for l, _ in model.infer(one[a])] == [a]
        for b in one:
            if a < b:
                # two thirds of one, one third of the other
                got = dict(model.infer(one[a][:1000] + " " + one[b][:500]))
                assert set(got) == {a, b} and got[a] == pytest.approx(2 / 3, abs=0.08)


def test_language_odd_rows(spark, model, odd_docs, no_docs):
    got = language.identify(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score", "languages"]
    by = collections.defaultdict(set)
    for r in got.collect():
        by[r.doc_id].add((r.lang_pred, r.score))
    for i in (2, 3, 4, 5):
        assert by[i] == {("und", 0.0)}
    assert all(0 < s <= 1 for i in (1, 6, 7, 8, None) for _, s in by[i])
    assert language.identify(no_docs, model).count() == 0
    empty = language.fit(no_docs, F.lit(True))
    assert {r.lang_pred for r in language.identify(odd_docs, empty).collect()} == {"und"}


def test_toxicity_held_out(spark):
    toxic = {r.doc_id: r.toxic for r in common.read(spark, SF, "labels").collect()}
    got = QUERIES["op6_toxicity_distance"](spark, SF).collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    hits = collections.Counter((toxic[r.doc_id], r.predicted) for r in got if r.held_out and toxic.get(r.doc_id) is not None)
    assert hits[0, 1] <= 0.02 * (hits[0, 0] + hits[0, 1])
    assert hits[1, 1] >= 0.7 * (hits[1, 0] + hits[1, 1])


def texts(n, bad):
    return [" ".join(f"{'ab'[k % 2]}word{(i * 31 + k * 7) % 83}" if k % 9 else ["vile", "nasty", "plain", "calm"][
        (i + k) % 2 + (0 if bad else 2)] for k in range(1, 80)) for i in range(n)]


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    model = toxicity.fit(texts(60, True), texts(180, False))
    score = model.scorer()
    assert score("plain calm " * 30)[0] < 0.3 and score("so vile and nasty a word")[0] >= 0.7
    assert score(None)[0] == score("")[0] == score("12 !!")[0] < 0.3
    got = toxicity.score(odd_docs, model)
    assert got.count() == odd_docs.count() and {r.predicted for r in got.collect()} == {0}
    assert "text" not in got.columns and got.columns.count("score") == 1
    assert toxicity.score(no_docs, model).count() == 0
    nothing = toxicity.fit([], texts(3, False))
    assert {r.score for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}


def mixed_texts(n, share, seed):
    """Texts of a skewed vocabulary; ``share`` of the words come from 12 that both classes use."""
    draw = random.Random(seed)
    plain = [f"w{i}x" for i in range(3000)]
    weight = [1 / (i + 5) for i in range(3000)]
    return [" ".join(f"harsh{draw.randrange(12)}" if draw.random() < share else w
                     for w in draw.choices(plain, weight, k=draw.randrange(40, 200))) for _ in range(n)]


def test_toxicity_wording_that_ordinary_texts_use_too():
    model = toxicity.fit(mixed_texts(150, 0.05, 1), mixed_texts(450, 0.002, 2))
    score = model.scorer()
    bad, good = ([score(t)[0] for t in mixed_texts(150, share, seed)] for share, seed in ((0.05, 3), (0.002, 4)))
    used = {w for t in mixed_texts(450, 0.002, 2) for w in t.split()}
    assert all(f"harsh{i}" in used for i in range(12))      # no word tells the classes apart by itself
    assert sum((b > g) + (b == g) / 2 for b in bad for g in good) > 0.8 * len(bad) * len(good)


def test_toxicity_is_no_word_membership():
    """Texts with the same set of words get different scores."""
    score = toxicity.fit(mixed_texts(150, 0.05, 1), mixed_texts(450, 0.002, 2)).scorer()
    plain = mixed_texts(1, 0, 5)[0]
    assert score("harsh1 harsh2 " * 4 + plain)[0] > 0.05 + score("harsh1 harsh2 " + " ".join([plain] * 6))[0]


def test_toxicity_sample_is_bounded_and_keeps_to_its_rows(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).union(
        spark.createDataFrame([(None, 1), (7, None), (9999, 1)], "doc_id bigint, toxic int"))
    bad, good = toxicity.training_sample(docs, labels, F.col("doc_id") < 200, sample=20, longest=100)
    assert 0 < len(bad) <= 40 and 0 < len(good) <= 120
    assert all(int(t[1:]) < 200 and int(t[1:]) % 2 for t in bad)
    assert toxicity.training_sample(docs.where("false"), labels.where("false"), F.lit(True), 20, 100) == ([], [])
