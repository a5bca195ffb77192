"""What queries exchange, write and send does not grow faster than their input."""

import glob
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from test_windows import random_sessions
from asofstore.operators import asof
from asofstore.operators import features as FE
from asofstore.operators import windows as WN
from asofstore.plans import catalog as C
from asofstore.sources import files as FS
from asofstore.sources.upsert import replace_rows
from asofstore.streaming import online


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_are_not_exchanged_after_the_pass(spark, results):
    store = FE.consolidated_features(results, 1995, 2001)
    labelled = C.LB.abt(store, C.LB.season_champions(results), C.ABT_START, C.ABT_STOP)
    assert "Exchange hashpartitioning" not in plan(store).split("MapInArrow")[0]
    assert "SortMergeJoin" not in plan(labelled).split("MapInArrow")[0]


def test_a_few_features_exchange_their_state_only(spark, results):
    pass_ = plan(FE.consolidated_features(results, 1995, 2001, features=["qtde_points_life"]))
    assert "qtde_points__s" in pass_ and "qtde_podios" not in pass_


def test_the_calendar_reads_sessions_once(spark, results):
    path = f"{tempfile.mkdtemp(prefix='asof-scale-', dir='/tmp')}/t"
    results.write.parquet(path)
    assert plan(asof.ranked_rounds(spark.read.parquet(path), 1995, 2001)).count("FileScan parquet") == 1


def test_eligible_drivers_are_made_without_an_exchange_of_their_dates(spark, results):
    assert "hashpartitioning(dt_ref" not in plan(asof.eligible_drivers(results, 1995, 2001)).split("Generate")[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_features_of_chosen_rows_are_those_of_the_store(spark, seed):
    data, windows = rows(spark, random_sessions(seed)), {"life": None, "two": 2}
    store = FE.consolidated_features(data, 1950, 2016, windows=windows)
    chosen = store.where("pmod(xxhash64(id), 2) = 0")
    narrow = chosen.select("id", "dt_ref", "driverid", F.lit(7).alias("mark"))
    got = FE.features_of(data, narrow, 1950, 2016, windows).where("mark = 7")
    key = lambda r: tuple(str(v) for v in r)
    want = chosen.drop("fullname", "teamname", "teamcolor")
    assert sorted(got.select(*want.columns).collect(), key=key) == sorted(want.collect(), key=key)


def test_running_sums_only_where_they_are_exact():
    values = np.array([[0.25, 3.0], [10.5, 0.0], [2.0, 1.0]])
    assert (WN._running(values) == [[0, 0], [0.25, 3], [10.75, 3], [12.75, 4]]).all()
    for odd in (0.1, np.inf, np.nan, 2.0 ** 60):
        assert WN._running(np.array([[1.0], [odd]])) is None


def test_a_csv_of_the_query_is_compressed(spark):
    path = tempfile.mkdtemp(prefix="asof-scale-", dir="/tmp")
    data = spark.createDataFrame([(1, "a;b"), (2, None), (3, "")], "k int, v string")
    FS.write_csv(data, path, compression="gzip")
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    assert sorted(map(tuple, FS.read_csv(spark, path, data.schema).collect())) == sorted(map(tuple, data.collect()), key=lambda r: r[0])


def test_rows_that_are_their_own_keys_are_evaluated_once(spark):
    table, seen = f"{tempfile.mkdtemp(prefix='asof-scale-', dir='/tmp')}/t", spark.sparkContext.accumulator(0)

    @F.udf("int")
    def marked(v):
        seen.add(1)
        return v

    for v in (1, 2):
        new = spark.createDataFrame([("a", v, 0), ("a", v + 5, 0), ("b", v, 1)], "k string, v int, p int").withColumn("v", marked("v"))
        replace_rows(spark, table, new, new, ["k"], "p")
    assert seen.value == 6
    assert sorted(map(tuple, spark.read.parquet(table).select("k", "v").collect())) == [("a", 2), ("a", 7), ("b", 2)]


def test_drivers_share_a_state(spark, results, monkeypatch):
    """With one group for all drivers the online table is the same."""
    data = [s for s in {s[:4]: s for s in random_sessions(6) if None not in (*s[:4], s[4])}.values()]
    found = []
    for groups in (1, 1 << 16):
        monkeypatch.setattr(online, "GROUPS", groups)
        root = tempfile.mkdtemp(prefix="asof-scale-", dir="/tmp")
        rows(spark, data).repartition(3).write.parquet(f"{root}/landing")
        online.follow(spark, f"{root}/landing", f"{root}/table", f"{root}/ckpt", rounds=4)
        found.append(sorted(map(str, spark.read.parquet(f"{root}/table").collect())))
    assert found[0] == found[1] and found[0]


def test_landed_files_do_not_follow_the_partitions(spark, monkeypatch):
    files = []
    whole = C.ingest_landing

    def counted(spark, landing, *args, **kw):
        files.extend(glob.glob(f"{landing.removeprefix('file:')}/*.parquet"))
        return whole(spark, landing, *args, **kw)

    monkeypatch.setattr(C, "ingest_landing", counted)
    got = C.QUERIES["stream_ingest"](spark, SF_SMALL)
    assert got.count() == C.results(spark, SF_SMALL).count()
    assert 30 <= len(files) <= 36


@pytest.mark.parametrize("seed", [3, 4])
def test_a_store_without_attributes_has_the_same_rows(spark, seed):
    data, windows = rows(spark, random_sessions(seed)), {"life": None, "two": 2}
    store = FE.consolidated_features(data, 1950, 2016, windows=windows).drop("fullname", "teamname", "teamcolor")
    narrow = FE.consolidated_features(data, 1950, 2016, windows=windows, attributes=False)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, store.collect())) and narrow.columns == store.columns


def test_samples_and_scores_carry_no_attributes(spark, monkeypatch):
    seen = []
    whole = C.written
    monkeypatch.setattr(C, "written", lambda df, name: (seen.append((name, df)), whole(df, name))[1])
    for query in ("test_set", "payload_rejects"):
        C.QUERIES[query](spark, SF_SMALL)
    stores = [df for name, df in seen if name != "sessions"]
    assert len(stores) == 2    # one table per query, besides the sessions
    for df in stores:
        assert "fullname" not in plan(df) and not re.search(r"hashpartitioning\(dt_ref#\d+, driverid", plan(df))


def test_boosted_rows_are_written_by_the_learner_only(spark, monkeypatch):
    seen, fitted = [], []
    whole = C.written
    monkeypatch.setattr(C, "written", lambda df, name: (seen.append(name), whole(df, name))[1])
    monkeypatch.setattr(C.ML, "pipeline", lambda *args: type("Fit", (), {"fit": lambda self, train: fitted.append(train)})())
    monkeypatch.setattr(C.ML, "boosting_rounds", lambda *args: None)
    C.QUERIES["adaboost_rounds"](spark, SF_SMALL)
    assert seen == ["sessions", "abt"] and fitted[0].columns == ["label", *C.BOOST_FEATS]


def test_a_payload_is_parsed_once(spark):
    from asofstore.operators import report
    from pyspark.sql import types as T
    asked = spark.createDataFrame([("a", "b")], "id string, word string").select("id", F.concat("word", F.lit("{")).alias("payload"))
    got = report.checked_records(asked, T.StructType([T.StructField("id", T.StringType())]))
    done = got._jdf.queryExecution().optimizedPlan().toString()
    assert done.lower().count("from_json(") + done.lower().count("jsontostructs") == 1 and done.count("concat(") == 1


def test_sessions_are_added_up_without_sorting(spark):
    path = tempfile.mkdtemp(prefix="asof-scale-", dir="/tmp")
    items = [(k, status, 1) for k, found in enumerate((["F", "O"], ["A", "F"], [None, "F"], [None], ["O"])) for status in found]
    spark.createDataFrame(items, "l_suppkey long, l_linestatus string, l_orderkey long").selectExpr(
        "*", "1 AS l_linenumber", "0.02D AS l_discount", "'A' AS l_returnflag", "DATE '1996-03-02' AS l_shipdate").write.parquet(f"{path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "'s' AS s_name", "0 AS s_nationkey").write.parquet(f"{path}/supplier.parquet")
    spark.range(1).selectExpr("id AS n_nationkey", "'n' AS n_name").write.parquet(f"{path}/nation.parquet")
    got = C.results(spark, path)
    assert "SortAggregate" not in plan(got)
    assert [r.status for r in got.orderBy("driverid").collect()] == ["Finished", "Lapped", "Finished", "Lapped", "Lapped"]


def test_repair_joins_keys_by_exchange(spark, results, tmp_path):
    """A table of keys is small as a file and large as a broadcast, so no join of the repair may guess its size."""
    from asofstore.schema import KEYS
    from asofstore.streaming import repair
    asof.eligible_drivers(results, 1995, 2001).write.parquet(f"{tmp_path}/pairs")
    asof.driver_seasons(results).groupBy("driverid").agg(F.min("first_d").alias("first_d")).write.parquet(f"{tmp_path}/drivers")
    pairs, drivers = spark.read.parquet(f"{tmp_path}/pairs"), spark.read.parquet(f"{tmp_path}/drivers")
    calendar = repair.calendar(results, 1995, 2001, {"_last_10": 10})
    for df in (FE.consolidated_features(results, 1995, 2001, probes=pairs), FE.window_features(results, 1995, 2001, probes=pairs),
               repair.affected(calendar, calendar, drivers, results, pairs.select(*KEYS), 1995, 2001)[1]):
        assert "driverid" in plan(df)
        assert not [x for x in plan(df).splitlines() if "BroadcastHashJoin" in x and "driverid" in x]


def test_eligible_results_exchange_no_fan_out(spark, results):
    """A session is in the windows of many dates: it meets its driver's dates before it is laid out, not after."""
    found = asof.eligible_results(results, 1995, 2001, 10)
    below = plan(found).split("Generate explode(filter(_dates", 1)
    assert len(below) == 2 and "Exchange" not in below[0]
    fan = asof.sessions_in_last_rounds(results, 1995, 2001, 10)
    literal = fan.join(asof.eligible_drivers(results, 1995, 2001), ["dt_ref", "driverid"], "left_semi").select(*found.columns)
    assert found.count() > 0 and found.exceptAll(literal).count() == 0 and literal.exceptAll(found).count() == 0


def test_a_merge_writes_its_rows_twice_and_searches_no_more_than_it_must(spark, results, tmp_path, monkeypatch):
    """Incoming rows are written for checking, merged partitions as the folders that are moved in; nothing a third time."""
    from pyspark.sql.readwriter import DataFrameWriter
    table, schema = f"{tmp_path}/t", "k string, v int, p string"
    replace_rows(spark, table, spark.createDataFrame([("a", 1, "x/y"), ("b", 1, "x/y"), ("c", 1, None)], schema), None, ["k"], "p")
    written, whole = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (written.append(path), whole(self, path, *a, **k))[1])
    replace_rows(spark, table, spark.createDataFrame([("b", 2, "z=1"), ("c", 2, "x/y")], schema), None, ["k"], "p")
    assert sorted(path.rsplit("/", 1)[1] for path in written) == ["incoming", "merged", "parts"]
    assert {tuple(r) for r in spark.read.schema(schema).parquet(table).collect()} == {("a", 1, "x/y"), ("b", 2, "z=1"), ("c", 2, "x/y")}
    assert not glob.glob(f"{table}/p=__HIVE*") and not glob.glob(f"{tmp_path}/*staging*")


def test_given_dates_limit_the_rows_that_are_made(spark, results):
    days = asof.dim_dates(results, 1995, 2001).where("dt_ref >= '2000-01-01'").select("dt_ref").distinct()
    some = FE.window_features(results, 1995, 2001, 10, dates=days)
    want = FE.window_features(results, 1995, 2001, 10).where("dt_ref >= '2000-01-01'")
    assert some.count() == want.count() > 0 and some.exceptAll(want).count() == 0
    assert plan(some).count("collect_list") == plan(FE.window_features(results, 1995, 2001, 10)).count("collect_list")
