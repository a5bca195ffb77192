"""Semantics of the feature, label, sampling and report operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from asofstore.operators import asof, labels, metrics, report, split
from asofstore.operators import features as FE


def ts(y, m, d):
    return dt.datetime(y, m, d)


def sess(driver, year, rnd, mode, date, pos=1.0, grid=1.0, pts=10.0, status="Finished",
         name="A", team="T", color="abc123"):
    return (driver, year, rnd, mode, date, pos, grid, pts, status, name, team, color)


def test_tie_season_goes_to_smallest_driverid(spark):
    df = rows(spark, [sess("d2", 1999, 1, "Race", ts(1999, 1, 28), pts=10.0),
                      sess("d1", 1999, 1, "Race", ts(1999, 1, 28), pts=10.0)])
    ch = labels.season_champions(df, exclude_year=2026).collect()
    assert [(r.year, r.driverid, r.rankdriver) for r in ch] == [(1999, "d1", 1)]


def test_no_sprint_gives_null_sprint_sums_and_zero_counts(spark):
    df = rows(spark, [sess("d1", 1999, 1, "Race", ts(1999, 1, 28)),
                      sess("d1", 1999, 2, "Race", ts(1999, 2, 28), pos=3.0)])
    out = FE.window_features(df, 1999, 1999, None).orderBy("dt_ref").collect()[-1]
    assert out.qtd_sessions == 2 and out.qtd_sprint == 0
    assert out.qtde_points_sprint is None and out.avg_position_sprint is None
    assert out.qtde_podios_sprint == 0 and out.avg_position == 2.0


def test_nan_becomes_null_at_ingest(spark):
    from asofstore.sources.tables import normalize_results
    df = rows(spark, [sess("d1", 1999, 1, "Race", ts(1999, 1, 28), pos=float("nan"),
                           grid=float("nan"), pts=float("nan"))])
    r = normalize_results(df).first()
    assert r.position is None and r.gridposition is None and r.points is None


def test_two_sessions_one_day_multiply_rows_unless_deduped(spark):
    df = rows(spark, [sess("d1", 1999, 1, "Race", ts(1999, 1, 28), name="A"),
                      sess("d1", 1999, 1, "Other", ts(1999, 1, 28), name="B")])
    assert FE.consolidated_features(df, 1999, 1999).count() == 2
    one = FE.consolidated_features(df, 1999, 1999, dedupe=True).collect()
    assert len(one) == 1 and one[0].fullname == "A"


def test_team_change_earliest_name_latest_colour(spark):
    df = spark.createDataFrame(
        [("d1", dt.date(1999, 1, 1), "Old Name", "aaaaaa", 1999),
         ("d1", dt.date(1999, 5, 1), "New Name", "#BBBBBB", 1999)],
        "driverid string, dt_ref date, fullname string, teamcolor string, year int")
    names = report.canonical_names(df).collect()
    assert names[0].fullname_correct == "Old Name"
    named = report.attach_names(df)
    colors = report.driver_colors(named).collect()
    assert colors[0].color == "#bbbbbb"


def test_short_season_is_trimmed_away(spark):
    df = spark.createDataFrame([(1999, dt.date(1999, m, 1)) for m in range(1, 5)]
                               + [(1998, dt.date(1998, m, 1)) for m in range(1, 9)],
                               "year int, dt_ref date")
    kept = split.season_tail_trim(df, 6).collect()
    assert {r.year for r in kept} == {1998} and len(kept) == 2


def test_score_ties_count_half(spark):
    df = spark.createDataFrame([("t", 0.5, 1), ("t", 0.5, 0), ("t", 0.9, 1), ("t", 0.1, 0)],
                               "split string, score double, flchampion int")
    auc = metrics.auc_by_split(df).first().auc
    # pairs: (0.9>0.5), (0.9>0.1), (0.5=0.5 -> 1/2), (0.5>0.1)
    assert auc == pytest.approx(3.5 / 4)


def test_auc_equals_mllib_evaluator(spark, results):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = results.select(F.lit("all").alias("split"),
                        F.coalesce(-F.col("gridposition"), F.lit(-99.0)).alias("score"),
                        (F.col("position") <= 3).cast("int").alias("flchampion")).na.fill(0)
    ours = metrics.auc_by_split(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC")
    ref = ev.evaluate(df.withColumn("label", F.col("flchampion").cast("double")))
    assert ours == pytest.approx(ref, abs=1e-6)


def test_career_equals_large_window(spark, results):
    a = FE.window_features(results, 1995, 2001, None)
    b = FE.window_features(results, 1995, 2001, 10000)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("last", [None, 2])
def test_sums_keep_their_precision_and_nan_is_null(spark, last):
    df = rows(spark, [sess("d1", 1999, 1, "Race", ts(1999, 1, 28), pts=1e-7),
                      sess("d1", 1999, 2, "Race", ts(1999, 2, 28), pts=1.23456789),
                      sess("d2", 1999, 1, "Race", ts(1999, 1, 28), pts=1e13),
                      sess("d2", 1999, 2, "Race", ts(1999, 2, 28), pts=float("nan"), pos=float("nan"))])
    out = {(r.driverid, r.dt_ref.month): r for r in FE.window_features(df, 1999, 1999, last).collect()}
    assert out["d1", 1].qtde_points == 1e-7
    assert out["d1", 2].qtde_points == 1e-7 + 1.23456789
    assert out["d2", 2].qtde_points == 1e13 and out["d2", 2].avg_position == 1.0
    assert out["d2", 2].qtd_sessions_with_points == 1


def test_ordered_output(spark, results):
    got = [(r.dt_ref, r.driverid) for r in FE.window_features(results, 2000, 2000, 10, order=True).collect()]
    assert got == sorted(got, key=lambda x: (-x[0].toordinal(), x[1]))


def test_nested_windows_never_count_more(spark, results):
    all_ = FE.consolidated_features(results, 1995, 2001)
    bad = all_.where((F.col("qtd_sessions_last_10") > F.col("qtd_sessions_last_20"))
                     | (F.col("qtd_sessions_last_20") > F.col("qtd_sessions_last_40"))
                     | (F.col("qtd_sessions_last_40") > F.col("qtd_sessions_life")))
    assert bad.count() == 0


def test_future_sessions_do_not_change_the_past(spark, results):
    cut = dt.date(1999, 1, 1)
    early = results.where(F.to_date("date") < F.lit(cut))
    a = FE.window_features(early, 1995, 2001, 10).where(F.col("dt_ref") < F.lit(cut))
    b = FE.window_features(results, 1995, 2001, 10).where(F.col("dt_ref") < F.lit(cut))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_race_sprint_other_add_up(spark, results):
    f = FE.window_features(results, 1995, 2001, None)
    other = results.where(~F.col("mode").isin("Race", "Sprint")).withColumn("mode", F.lit("Race"))
    o = FE.window_features(other, 1995, 2001, None).select("dt_ref", "driverid", F.col("qtd_race").alias("o"))
    j = f.join(o, ["dt_ref", "driverid"], "left").na.fill(0, ["o"])
    # the driver's last session of another type may be too old for eligibility among those alone
    recent = j.where("o > 0")
    assert recent.count() > 0
    assert recent.where("qtd_race + qtd_sprint + o != qtd_sessions").count() == 0


def test_auc_of_odd_scores(spark):
    kind = "split string, score double, flchampion int"
    for bad in (None, float("nan")):
        with pytest.raises(Exception, match="NULL or NaN"):
            metrics.auc_by_split(spark.createDataFrame([("t", bad, 1), ("t", 0.5, 0)], kind)).collect()
    assert metrics.auc_by_split(spark.createDataFrame([], kind)).collect() == []


def test_auc_in_many_ranges(spark, monkeypatch):
    df = spark.range(2000).select(F.lit("t").alias("split"), F.pmod(F.xxhash64("id"), F.lit(700)).cast("double")
                                  .alias("score"), (F.pmod(F.hash("id"), F.lit(3)) == 0).cast("int").alias("flchampion"))
    one = metrics.auc_by_split(df).first().auc
    monkeypatch.setattr(metrics, "RANGE_ROWS", 50)
    assert metrics.auc_by_split(df).first().auc == pytest.approx(one, abs=1e-12)


def test_grid_lists_seasons_without_a_session(spark):
    from asofstore.operators import ingest
    df = rows(spark, [sess("d1", 1999, 1, "Race", ts(1999, 1, 28))])
    missing = ingest.missing_sessions(ingest.session_grid(df, 2, years=(1999, 2000)), df)
    assert {(r.year, r.roundnumber, r.mode) for r in missing.collect()} == {
        (1999, 2, "Race"), (2000, 1, "Race"), (2000, 2, "Race"), (1999, 1, "Sprint")}


def test_missing_feature_column_fails(spark):
    from asofstore.operators import ml
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 1.0, 1.0)], "a double, b double, label double")
    model = ml.pipeline(["a", "b"], ml.AdaBoostStumps(numRounds=1)).fit(df)
    with pytest.raises(Exception, match="b"):
        model.transform(df.drop("b")).collect()


def test_eligibility_needs_recent_season(spark):
    df = rows(spark, [sess("old", 1995, 1, "Race", ts(1995, 1, 28)),
                      sess("new", 1999, 1, "Race", ts(1999, 1, 28))])
    e = {(r.dt_ref.year, r.driverid) for r in asof.eligible_drivers(df, 1999, 1999).collect()}
    assert e == {(1999, "new")}


def test_payload_guards(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "id string, x double")
    with pytest.raises(ValueError):
        report.require_unique(df)
    with pytest.raises(ValueError):
        report.require_rows(df.where("x > 5"))


def test_latest_model_is_numeric_max(spark):
    from asofstore.sources.registry import latest_model
    reg = spark.createDataFrame([("m", "9", "/a"), ("m", "10", "/b"), ("x", "99", "/c")],
                                "name string, version string, path string")
    r = latest_model(reg, "m").first()
    assert (r.version, r.path) == ("10", "/b")


def test_open_season_range_has_no_nested_loop(spark, results):
    """Without a range the same rows come from equi-joins and arrays of the calendar."""
    for open_, closed in ((asof.eligible_drivers(results), asof.eligible_drivers(results, 1900, 2100)),
                          (asof.ranked_rounds(results), asof.ranked_rounds(results, 1900, 2100)),
                          (asof.last_rounds(results, n=3), asof.ranked_rounds(results, 1900, 2100).where("rn <= 3")),
                          (FE.window_features(results), FE.window_features(results, 1900, 2100))):
        plan = open_._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert open_.exceptAll(closed).count() == 0 and closed.exceptAll(open_).count() == 0


def test_forest_cuts_at_every_distinct_value(spark):
    from asofstore.operators import ml
    df = spark.range(300).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id > 250 AS DOUBLE) AS label")
    assert ml.pipeline(["x"], ml.random_forest(trees=2, min_leaf=1, max_depth=2)).fit(df).stages[-1].getMaxBins() == 300
    assert ml.pipeline(["x"], ml.random_forest(trees=2, min_leaf=1, max_depth=2, max_bins=8)).fit(df).stages[-1].getMaxBins() == 8
