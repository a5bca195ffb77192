"""Model stages, boosting, persistence, streaming ingestion and stream scoring."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from asofstore.operators import ml as ML
from asofstore.operators import features as FE


@pytest.fixture(scope="module")
def train(spark, results):
    f = FE.consolidated_features(results, 1995, 2001)
    return (f.withColumn("label", (F.col("qtde_1pos_last_10") > 0).cast("double"))
            .checkpoint(eager=True))


FEATS = FE.all_feature_names()


def test_imputer_fills_features_only(spark):
    df = spark.createDataFrame([("x", None, None)], "name string, a double, b bigint")
    out = ML.ArbitraryImputer(inputCols=["a", "b"], value=-1000.0).transform(df).first()
    assert out.a == -1000.0 and out.b == -1000.0 and out.name == "x"


def test_adaboost_rounds_and_probabilities(spark, train):
    model = ML.pipeline(FEATS, ML.AdaBoostStumps(numRounds=4, learningRate=0.5)).fit(train)
    st = model.stages[-1].getOrDefault("stumps")
    assert 1 <= len(st) <= 4
    p = model.transform(train).select("prob_win").toPandas()["prob_win"]
    assert ((p > 0) & (p < 1)).all()
    imp = model.stages[-1].feature_importances()
    assert imp.sum() == pytest.approx(1.0) and np.count_nonzero(imp) <= 4


def test_adaboost_stops_at_a_perfect_stump(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 1.0), (3.0, 1.0)], "x double, label double")
    model = ML.pipeline(["x"], ML.AdaBoostStumps(numRounds=2)).fit(df)
    st = model.stages[-1].getOrDefault("stumps")
    assert len(st) == 1
    assert st[0][0] == 0 and st[0][1] == 1.5 and tuple(st[0][2:4]) == (0, 1)


@pytest.mark.parametrize("most", [512, 1])
def test_adaboost_two_rounds_by_hand(spark, most):
    # labels 0 1 0 1 1 over x = 0..4 and z; round 1: x <= 2 has one error (x = 1),
    # x <= 0 has one error (x = 2): the purer split by Gini is x <= 0
    data = [(0.0, 0.0), (1.0, 1.0), (2.0, 0.0), (3.0, 1.0), (4.0, 1.0)]
    df = spark.createDataFrame(data, "x double, label double")
    model = ML.pipeline(["x"], ML.AdaBoostStumps(numRounds=2, learningRate=1.0, maxPatterns=most)).fit(df)
    st = model.stages[-1].getOrDefault("stumps")
    weights, x, y = np.ones(5), np.arange(5.0), np.array([0, 1, 0, 1, 1])
    for _, thr, lc, rc, alpha in st:
        pred = np.where(x <= thr, lc, rc)
        err = weights[pred != y].sum() / weights.sum()
        gini = {}
        for t in (0.5, 1.5, 2.5, 3.5):
            total = 0.0
            for side in (x <= t, x > t):
                w = np.array([weights[side & (y == k)].sum() for k in (0, 1)])
                total += w.sum() * (1 - ((w / w.sum()) ** 2).sum())
            gini[t] = total
        assert thr == min(gini, key=lambda t: (round(gini[t], 12), t))
        assert alpha == pytest.approx(np.log((1 - err) / err))
        weights = weights * np.exp(alpha * (pred != y))
    assert len(st) == 2
    vote = sum(a * np.where(x <= t, 2 * lc - 1, 2 * rc - 1) for _, t, lc, rc, a in st) / sum(s[4] for s in st)
    got = [r.prob_win for r in model.transform(df).orderBy("x").collect()]
    assert got == pytest.approx(list(1 / (1 + np.exp(-2 * vote))))


def test_adaboost_patterns_equal_a_job_per_round(spark, train):
    fit = lambda most: ML.pipeline(FEATS, ML.AdaBoostStumps(numRounds=8, learningRate=0.5, maxPatterns=most)).fit(
        train).stages[-1].getOrDefault("stumps")
    a, b = fit(512), fit(2)
    assert [s[:4] for s in a] == [s[:4] for s in b]
    assert [s[4] for s in a] == pytest.approx([s[4] for s in b])


def test_adaboost_save_load_and_stream_scoring(spark, train):
    from pyspark.ml import PipelineModel
    from asofstore.streaming.ingest import score_stream
    model = ML.pipeline(FEATS, ML.AdaBoostStumps(numRounds=3, learningRate=0.5)).fit(train)
    root = tempfile.mkdtemp(prefix="asof-ada-", dir="/tmp")
    model.write().overwrite().save(root + "/m")
    train.drop("label").limit(20).write.parquet(root + "/in")
    stream = spark.readStream.schema(train.drop("label").schema).parquet(root + "/in")
    q = (score_stream(PipelineModel.load(root + "/m"), stream).select("id", "prob_win").writeStream.format("memory")
         .queryName("scores_ada").trigger(availableNow=True).start())
    q.awaitTermination()
    want = {r.id: r.prob_win for r in model.transform(spark.read.parquet(root + "/in")).collect()}
    assert {r.id: r.prob_win for r in spark.sql("SELECT * FROM scores_ada").collect()} == want


def test_model_choice_by_metric(spark):
    m = spark.createDataFrame([("a", "oot", 0.7), ("b", "oot", 0.8), ("a", "test", 0.9)],
                              "model string, split string, auc double")
    assert ML.best_model(m) == "b" and ML.best_model(m, "test") == "a"


def test_random_forest_save_load_and_stream_scoring(spark, train):
    from pyspark.ml import PipelineModel
    from asofstore.streaming.ingest import score_stream
    model = ML.pipeline(FEATS, ML.random_forest(trees=5, min_leaf=5)).fit(train)
    path = tempfile.mkdtemp(prefix="asof-model-", dir="/tmp")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    src = tempfile.mkdtemp(prefix="asof-stream-", dir="/tmp")
    train.drop("label").limit(50).write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(train.drop("label").schema).parquet(src + "/in")
    q = (score_stream(loaded, stream).select("id", "prob_win").writeStream.format("memory")
         .queryName("scores_t").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM scores_t")
    assert got.count() == 50 and got.where("prob_win < 0 OR prob_win > 1").count() == 0
    imp = ML.feature_importance(loaded, FEATS, spark)
    assert imp.count() == 172


def test_stream_ingest_filters_non_parquet_and_is_idempotent(spark, results):
    from asofstore.streaming.ingest import ingest_landing
    root = tempfile.mkdtemp(prefix="asof-landing-", dir="/tmp")
    landing, bronze, ckpt = root + "/landing", root + "/bronze", root + "/ckpt"
    results.where("year <= 1997").write.mode("append").parquet(landing)
    with open(os.path.join(landing, "notes.csv"), "w") as fh:
        fh.write("driverid;year\nzzz;1999\n")
    ingest_landing(spark, landing, bronze, ckpt)
    first = spark.read.parquet(bronze).count()
    results.where("year > 1997").write.mode("append").parquet(landing)
    ingest_landing(spark, landing, bronze, ckpt)
    ingest_landing(spark, landing, bronze, ckpt)          # nothing new: no change
    got = spark.read.parquet(bronze).select(*results.columns)
    assert first == results.where("year <= 1997").count()
    assert got.exceptAll(results).count() == 0 and results.exceptAll(got).count() == 0


def test_upsert_is_idempotent(spark, results):
    from asofstore.sources.upsert import upsert
    root = tempfile.mkdtemp(prefix="asof-upsert-", dir="/tmp")
    tbl = root + "/t"
    keys = ["driverid", "year", "roundnumber", "mode"]
    upsert(spark, tbl, results, keys, "year")
    upsert(spark, tbl, results.where("year = 1999"), keys, "year")
    got = spark.read.parquet(tbl).select(*results.columns)
    assert got.exceptAll(results).count() == 0 and results.exceptAll(got).count() == 0


def test_upsert_moves_keys_and_keeps_null_partitions(spark):
    from asofstore.sources.upsert import upsert
    root = tempfile.mkdtemp(prefix="asof-upsert-", dir="/tmp")
    kind = "k string, v int, p int"
    rows = lambda d: spark.createDataFrame(d, kind)
    read = lambda: sorted(((r.k or "", r.v, r.p or 0) for r in spark.read.schema(kind).parquet(root + "/t").collect()))
    upsert(spark, root + "/t", rows([("a", 1, None), ("b", 1, 1998), ("c", 1, 1999), (None, 1, 1998)]), ["k"], "p")
    upsert(spark, root + "/t", rows([("d", 2, None), ("b", 2, 1999), (None, 2, 1998)]), ["k"], "p")
    assert read() == [("", 2, 1998), ("a", 1, 0), ("b", 2, 1999), ("c", 1, 1999), ("d", 2, 0)]
    upsert(spark, root + "/t", rows([("c", 3, 2000), ("b", 3, 2000)]), ["k"], "p")       # empties 1999
    assert read() == [("", 2, 1998), ("a", 1, 0), ("b", 3, 2000), ("c", 3, 2000), ("d", 2, 0)]
    with pytest.raises(ValueError, match="duplicate key"):
        upsert(spark, root + "/t", rows([("x", 1, 1), ("x", 2, 1)]), ["k"], "p")
    assert os.listdir(root) == ["t"]


def test_stream_takes_the_newest_of_one_batch_and_archives(spark, results):
    from asofstore.sources.files import write_sessions
    from asofstore.streaming.ingest import ingest_landing
    root = tempfile.mkdtemp(prefix="asof-fix-", dir="/tmp")
    one = results.where("year = 1999 AND roundnumber = 1").limit(3)
    one.coalesce(1).write.mode("append").parquet(root + "/landing")
    fixed = one.withColumn("points", F.lit(77.25))
    import time
    time.sleep(1.1)
    fixed.coalesce(1).write.mode("append").parquet(root + "/landing")
    ingest_landing(spark, root + "/landing", root + "/bronze", root + "/ckpt", max_files_per_trigger=10,
                   archive_dir=root + "/archive")
    got = spark.read.parquet(root + "/bronze")
    assert got.count() == 3 and {r.points for r in got.collect()} == {77.25}
    write_sessions(got, root + "/sink")
    assert spark.read.parquet(root + "/sink").where("year = 1999 AND roundnumber = 1").count() == 3


def test_no_silent_local_folder_on_a_cluster(spark):
    from asofstore import session

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
