"""Store repair, file ledger, online state, published versions and the registry, also when a run stops half way."""

import os
import random
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_windows import random_sessions
from asofstore.operators import features as FE
from asofstore.schema import SESSION_RESULTS
from asofstore.sources import files as FS
from asofstore.sources.registry import latest_model, next_version
from asofstore.streaming import ingest, online, repair

YEARS = (1995, 2016)


def folder():
    return tempfile.mkdtemp(prefix="asof-landing-", dir="/tmp")


def sessions(seed):
    """Unique session keys without nulls in them."""
    found = {}
    for s in random_sessions(seed):
        if None not in (*s[:4], s[4]):
            found[s[:4]] = s
    return list(found.values())


def same(a, b):
    key = lambda r: tuple(str(v) for v in r)
    return sorted((tuple(r) for r in a.collect()), key=key) == sorted((tuple(r) for r in b.select(*a.columns).collect()), key=key)


def late_batches():
    """Three batches out of order; the last moves a session to another day, which empties a date."""
    data = sessions(4)
    random.Random(0).shuffle(data)
    moved = [(*s[:4], s[4].replace(year=s[4].year, month=13 - s[4].month), *s[5:]) for s in data[:4]]
    final = {s[:4]: s for s in data} | {s[:4]: s for s in moved}
    return [data[:25], data[25:], moved], list(final.values())


def test_repaired_store_equals_one_from_scratch(spark):
    batches, final = late_batches()
    windows = {"life": None, "three": 3}
    keeper = repair.StoreRepair(spark, folder(), *YEARS, windows=windows)
    for i, batch in enumerate(batches):
        keeper.merge(rows(spark, batch), i)
    want = FE.consolidated_features(rows(spark, final), *YEARS, windows=windows)
    assert same(want, keeper.read())
    log = {r["batch"]: r for r in spark.read.schema(repair.LOG).parquet(keeper.log).collect()}
    assert [log[i]["n_sessions"] for i in range(3)] == [len(b) for b in batches]
    assert all(log[i]["n_rows"] <= keeper.read().count() + 4 and log[i]["n_pairs"] > 0 for i in range(3))
    assert not os.listdir(f"{keeper.root}/pending")


@pytest.mark.parametrize("stop_in", ["upsert", "replace_rows"])
def test_a_batch_that_stopped_half_way_is_finished(spark, monkeypatch, stop_in):
    batches, final = late_batches()
    windows = {"two": 2}
    keeper = repair.StoreRepair(spark, folder(), *YEARS, windows=windows)
    keeper.merge(rows(spark, batches[0] + batches[1]), 0)
    whole = getattr(repair, stop_in)

    def stopped(*args, **kw):
        if stop_in == "upsert":
            whole(*args, **kw)      # sessions are in, the store is not repaired
        raise RuntimeError("lost")

    monkeypatch.setattr(repair, stop_in, stopped)
    with pytest.raises(RuntimeError, match="lost"):
        keeper.merge(rows(spark, batches[2]), 1)
    monkeypatch.setattr(repair, stop_in, whole)
    keeper.merge(rows(spark, batches[2]), 1)
    assert same(FE.consolidated_features(rows(spark, final), *YEARS, windows=windows), keeper.read())


def test_a_round_that_lands_late_repairs_the_windows_of_all_drivers(spark):
    base = [s for s in sessions(4)]
    target = max(s[1:3] for s in base)
    late, early = [s for s in base if s[1:3] == target], [s for s in base if s[1:3] != target]
    keeper = repair.StoreRepair(spark, folder(), *YEARS, windows={"two": 2})
    keeper.merge(rows(spark, early), 0)
    keeper.merge(rows(spark, late), 1)
    log = {r["batch"]: r for r in spark.read.schema(repair.LOG).parquet(keeper.log).collect()}
    assert log[1]["n_dates"] > 0
    assert same(FE.consolidated_features(rows(spark, base), *YEARS, windows={"two": 2}), keeper.read())


def land(spark, data, path):
    rows(spark, data).coalesce(1).write.mode("append").parquet(path)


def test_ledger_and_files_agree_after_a_stop_between_write_and_delete(spark):
    root, data = folder(), sessions(5)
    landing, ledger = f"{root}/landing", f"{root}/ledger"
    land(spark, data[:9], landing)
    land(spark, data[9:20], landing)
    land(spark, [(None, *data[20][1:]), data[21]], landing)
    files = lambda: [f for f in os.listdir(landing) if f.endswith(".parquet")]
    ingest.ingest_with_ledger(spark, landing, f"{root}/bronze", ledger, f"{root}/ckpt", clean=False)    # stops before deleting
    assert len(files()) == 3
    kept = sorted((r.n_rows, r.n_bad, r.ok) for r in ingest.read_ledger(spark, ledger).collect())
    assert kept == [(2, 1, False), (9, 0, True), (11, 0, True)]
    land(spark, data[22:25], landing)
    ingest.ingest_with_ledger(spark, landing, f"{root}/bronze", ledger, f"{root}/ckpt")
    assert len(files()) == 1        # the refused file
    assert ingest.delete_landed(spark, landing, ledger) == 0
    assert same(rows(spark, data[:20] + data[22:25]), spark.read.schema(SESSION_RESULTS).parquet(f"{root}/bronze"))


def test_a_batch_that_is_tried_again_has_one_ledger_row_per_file(spark, monkeypatch):
    root, data = folder(), sessions(5)
    land(spark, data[:9], f"{root}/landing")
    upsert, tries = ingest.upsert, []

    def once(*args):
        upsert(*args)
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "upsert", once)
    args = (spark, f"{root}/landing", f"{root}/bronze", f"{root}/ledger", f"{root}/ckpt")
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_with_ledger(*args)
    assert len([f for f in os.listdir(f"{root}/landing") if f.endswith(".parquet")]) == 1
    ingest.ingest_with_ledger(*args)
    assert [(r.n_rows, r.ok) for r in ingest.read_ledger(spark, f"{root}/ledger").collect()] == [(9, True)]
    assert not [f for f in os.listdir(f"{root}/landing") if f.endswith(".parquet")]


def test_delete_and_archive_by_the_stream_itself(spark):
    root, data = folder(), sessions(5)
    for i in range(3):
        land(spark, data[5 * i:5 * i + 5], f"{root}/landing")
    for _ in range(2):      # a file goes once a later batch has begun
        ingest.ingest_landing(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", archive_dir="")
    assert len([f for f in os.listdir(f"{root}/landing") if f.endswith(".parquet")]) < 3
    assert spark.read.parquet(f"{root}/bronze").count() == 15


@pytest.mark.parametrize("seed", [6])
def test_online_state_equals_the_store_at_the_newest_date(spark, seed):
    data, root = sessions(seed), folder()
    random.Random(seed).shuffle(data)
    wrong = [(*s[:5], 99.0, *s[6:]) for s in data[:3]]      # earlier forms of sessions that are corrected later
    shared = f"{root}/landing"
    for part in (wrong, data[20:], data[:20]):
        land(spark, part, shared)
        online.follow(spark, shared, f"{root}/online", f"{root}/ckpt-online", rounds=4)
    got = online.online_features(spark, f"{root}/online", *YEARS, last_rounds=4)
    want = FE.window_features(rows(spark, data), *YEARS, 4)
    newest = want.agg(F.max("dt_ref")).first()[0]
    assert same(want.where(F.col("dt_ref") == F.lit(newest)), got)
    kept = spark.read.parquet(f"{root}/online")
    assert kept.groupBy("driverid").agg(F.countDistinct("year", "roundnumber").alias("n")).agg(F.max("n")).first()[0] <= 5


def test_readers_before_and_after_a_swap_see_one_whole_version(spark):
    root = folder() + "/table"
    FS.publish(spark.range(100).repartition(4), root)
    before = FS.read_published(spark, root)
    FS.publish(spark.range(1000, 1300).repartition(7), root)
    after = FS.read_published(spark, root)
    assert before.count() == 100 and after.count() == 300 and before.agg(F.max("id")).first()[0] == 99
    FS.publish(spark.range(5), root)
    assert FS.read_published(spark, root).count() == 5
    assert len([f for f in os.listdir(root) if f.startswith("v-")]) == 2
    assert [f for f in os.listdir(root) if f.startswith("_v-")] == []


def test_concurrent_registrations_get_their_own_versions(spark):
    root = folder()
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda _: next_version(spark, root, "m"), range(12)))
    assert sorted(map(int, versions)) == list(range(1, 13))
    assert next_version(spark, root, "other") == "1"


def test_registered_model_is_loaded_by_its_newest_version(spark):
    from pyspark.ml import PipelineModel
    from asofstore.operators import ml as ML
    from asofstore.sources.registry import register_model
    root = folder()
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (2.0, 1.0)], "x double, label double")
    for x in (1, 2):
        model = ML.pipeline(["x"], ML.AdaBoostStumps(numRounds=x)).fit(df)
        assert register_model(f"{root}/registry", model, "title", f"{root}/models", spark) == str(x)
    newest = latest_model(spark.read.parquet(f"{root}/registry"), "title").first()
    assert newest["version"] == "2" and PipelineModel.load(newest["path"]).transform(df).count() == 3
