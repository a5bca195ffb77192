"""Registry of named queries over the given tables, with their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the whole given
tables (through :func:`asofstore.sources.tables.session_results`); each
oracle is literal SQL over the same tables. Parameters that the data model
leaves open are fixed here for the test data: seasons 1995-2001 are all
seasons present, so every query covers the whole history.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof
from ..operators import features as FE
from ..session import scratch_dir
from ..sources.tables import session_results
from . import oracle_features as OF

# Parameters for the test data.
YEAR_START, YEAR_STOP = 1995, 2001
LAST_N = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _base(select: str) -> str:
    return f"WITH {OF.base_ctes(YEAR_START, YEAR_STOP)}\n{select}"


def results(spark, sf_dir):
    return session_results(spark, sf_dir)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, where one query reads an
    expensive relation several times."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sessions(spark, sf_dir):
    """The session results, written once, for queries that read them several times."""
    return written(results(spark, sf_dir), "sessions")


# ------------------------------------------------------------ step 1 and 2

@register("session_results", f"{OF.SESSION_RESULTS_SQL}")
def q_session_results(spark, sf):
    return results(spark, sf)


@register("dim_dates", _base("SELECT * FROM dim_dates"))
def q_dim_dates(spark, sf):
    return asof.dim_dates(results(spark, sf), YEAR_START, YEAR_STOP)


@register("past_sessions", _base(
    "SELECT dt_ref, ref_year, CAST(count(*) AS BIGINT) AS n_sessions, sum(points) AS sum_points,"
    " CAST(count(DISTINCT CAST(date AS DATE)) AS BIGINT) AS n_session_dates"
    " FROM past_sessions GROUP BY dt_ref, ref_year"))
def q_past_sessions(spark, sf):
    return asof.sessions_known_at(results(spark, sf), YEAR_START, YEAR_STOP)


@register("distinct_rounds", _base("SELECT * FROM distinct_rounds"))
def q_distinct_rounds(spark, sf):
    return asof.distinct_rounds(results(spark, sf), YEAR_START, YEAR_STOP)


@register("ranked_rounds", _base("SELECT dt_ref, year, roundnumber, CAST(rn AS INT) AS rn FROM ranked_rounds"))
def q_ranked_rounds(spark, sf):
    return asof.ranked_rounds(results(spark, sf), YEAR_START, YEAR_STOP)


@register("last_rounds", _base(
    f"SELECT dt_ref, year, roundnumber, CAST(rn AS INT) AS rn FROM ranked_rounds WHERE rn <= {LAST_N}"))
def q_last_rounds(spark, sf):
    return asof.last_rounds(results(spark, sf), YEAR_START, YEAR_STOP, LAST_N)


@register("eligible_drivers", _base("SELECT * FROM eligible_drivers"))
def q_eligible_drivers(spark, sf):
    return asof.eligible_drivers(sessions(spark, sf), YEAR_START, YEAR_STOP)


_ELIG_COLS = ["dt_ref", "driverid", "year", "roundnumber", "mode", "position",
              "gridposition", "points", "status"]


@register("eligible_results", _base(
    "SELECT t1.dt_ref, t1.driverid, t1.year, t1.roundnumber, t1.mode, CAST(t1.date AS DATE) AS session_date,"
    " t1.position, t1.gridposition, t1.points, t1.status"
    " FROM past_sessions AS t1"
    " JOIN eligible_drivers AS t2 ON t1.dt_ref = t2.dt_ref AND t1.driverid = t2.driverid"
    f" JOIN (SELECT * FROM ranked_rounds WHERE rn <= {LAST_N}) AS t3"
    " ON t1.dt_ref = t3.dt_ref AND t1.year = t3.year AND t1.roundnumber = t3.roundnumber"))
def q_eligible_results(spark, sf):
    r = asof.eligible_results(sessions(spark, sf), YEAR_START, YEAR_STOP, LAST_N)
    return r.select(*_ELIG_COLS, F.col("d").alias("session_date"))


def _window_query(name, n):
    @register(name, OF.window_features_sql(YEAR_START, YEAR_STOP, n or 10000))
    def q(spark, sf):
        return FE.window_features(sessions(spark, sf), YEAR_START, YEAR_STOP, n)
    return q


_window_query("driver_features_last_10", 10)
_window_query("driver_features_last_20", 20)
_window_query("driver_features_last_40", 40)
_window_query("driver_features_life", None)


@register("driver_features_all", OF.consolidated_sql(YEAR_START, YEAR_STOP))
def q_driver_features_all(spark, sf):
    return FE.consolidated_features(sessions(spark, sf), YEAR_START, YEAR_STOP)


@register("feature_id", OF.consolidated_sql(
    YEAR_START, YEAR_STOP, "SELECT id, dt_ref, driverid FROM fs_all"))
def q_feature_id(spark, sf):
    return q_driver_features_all(spark, sf).select("id", "dt_ref", "driverid")


# ------------------------------------------------------------ step 3: labels, ABT

from ..functions import scalar as SC  # noqa: E402
from ..operators import labels as LB  # noqa: E402
from ..operators import metrics as MT  # noqa: E402
from ..operators import report as RP  # noqa: E402
from ..operators import split as SP  # noqa: E402

# ABT window, out-of-time season, trim and split parameters for
# the test data (seasons 1995-2001; the reference uses 2000-2026 and 2025).
ABT_START, ABT_STOP, OOT_YEAR = "1995-01-01", "2002-01-01", 2001
DROP_LATEST, TRAIN_FRAC, SEED = 6, 0.8, 42

_LABEL_CTES = f"""{OF.consolidated_ctes(YEAR_START, YEAR_STOP)},
season_points AS (
  SELECT CAST(year AS INT) AS year, driverid, sum(points) AS totalpoints
  FROM session_results
  WHERE mode IN ('Race', 'Sprint') AND year <> year(current_date)
  GROUP BY ALL),
season_champions AS (
  SELECT p.*, 1 AS rankdriver FROM season_points AS p
  WHERE p.driverid = (SELECT min(q.driverid) FROM season_points AS q WHERE q.year = p.year
    AND q.totalpoints = (SELECT max(r.totalpoints) FROM season_points AS r WHERE r.year = q.year))),
abt AS (
  SELECT fs_all.*, CASE WHEN (year(dt_ref), driverid) IN (SELECT (year, driverid) FROM season_champions)
    THEN 1 ELSE 0 END AS flchampion
  FROM fs_all WHERE dt_ref >= DATE '{ABT_START}' AND dt_ref < DATE '{ABT_STOP}'),
abty AS (SELECT *, CAST(year(dt_ref) AS INT) AS year FROM abt),
analytics AS (SELECT * FROM abty WHERE year < {OOT_YEAR}),
oot AS (SELECT * FROM abty WHERE year = {OOT_YEAR}),
season_dates AS (SELECT DISTINCT year, dt_ref FROM analytics),
trimmed AS (
  SELECT year, dt_ref FROM (
    SELECT year, dt_ref, row_number() OVER (PARTITION BY year ORDER BY dt_ref DESC) - 1 AS rk
    FROM season_dates) AS r
  WHERE rk >= {DROP_LATEST}),
units AS (SELECT DISTINCT driverid, year, flchampion FROM analytics),
split_units AS (
  SELECT driverid, year, flchampion,
    CASE WHEN row_number() OVER (PARTITION BY flchampion
              ORDER BY md5(driverid || '|' || CAST(year AS VARCHAR) || '|{SEED}'))
           <= floor({TRAIN_FRAC} * count(*) OVER (PARTITION BY flchampion))
         THEN 'train' ELSE 'test' END AS split
  FROM units),
chosen AS (
  SELECT s.split, a.* FROM split_units AS s
  JOIN analytics AS a ON s.driverid = a.driverid AND s.year = a.year AND s.flchampion = a.flchampion
  JOIN trimmed AS t ON a.year = t.year AND a.dt_ref = t.dt_ref),
scored AS (
  SELECT *, COALESCE(qtde_points_last_10 / (1 + qtde_points_life), 0) AS score FROM chosen
  UNION ALL
  SELECT 'oot' AS split, *, COALESCE(qtde_points_last_10 / (1 + qtde_points_life), 0) AS score FROM oot)"""


def _labels(select: str) -> str:
    return f"WITH {_LABEL_CTES}\n{select}"


def features_all(spark, sf, features=None, attributes=True):
    """The consolidated store, lazily; ``features`` limits its feature columns."""
    return FE.consolidated_features(sessions(spark, sf), YEAR_START, YEAR_STOP, features=features, attributes=attributes)


def champions(spark, sf):
    return LB.season_champions(results(spark, sf))


def abt_table(spark, sf, features=None, res=None, attributes=True):
    res = sessions(spark, sf) if res is None else res
    store = FE.consolidated_features(res, YEAR_START, YEAR_STOP, features=features, attributes=attributes)
    return LB.abt(store, LB.season_champions(res), ABT_START, ABT_STOP)


_SCORE_FEATS = ["qtde_points_last_10", "qtde_points_life"]


def written_abt(spark, sf, features=(), res=None):
    """The ABT with the features that a query needs and without attributes, which no sample reads; evaluated once."""
    return written(abt_table(spark, sf, list(features), res, attributes=False), "abt")


def sampling(spark, sf, features=(), res=None):
    """analytics, oot, trimmed dates, split units, train, test."""
    analytics, oot = SP.oot_split(written_abt(spark, sf, features, res), OOT_YEAR)
    trimmed = SP.season_tail_trim(analytics, DROP_LATEST)
    units = SP.stratified_split(SP.driver_year_labels(analytics), TRAIN_FRAC, SEED)
    train, test = SP.split_sets(units, analytics, trimmed)
    return analytics, oot, trimmed, units, train, test


def train_features(spark, sf, keys):
    """``keys`` of the train rows with all features: rows are chosen while they are narrow, their features made after."""
    res = sessions(spark, sf)
    return FE.features_of(res, sampling(spark, sf, res=res)[4].select(*keys), YEAR_START, YEAR_STOP)


def surrogate_score():
    """Fixed scoring rule standing in for a model where results must be exact."""
    return F.coalesce(F.col("qtde_points_last_10") / (1 + F.col("qtde_points_life")), F.lit(0.0))


def scored_splits(spark, sf):
    _, oot, _, _, train, test = sampling(spark, sf, _SCORE_FEATS)
    parts = [train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test")),
             oot.withColumn("split", F.lit("oot"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("score", surrogate_score())


@register("season_points", _labels("SELECT * FROM season_points"))
def q_season_points(spark, sf):
    return LB.season_points(results(spark, sf))


@register("season_champions", _labels("SELECT * FROM season_champions"))
def q_season_champions(spark, sf):
    return champions(spark, sf)


@register("abt", _labels("SELECT * FROM abt"))
def q_abt(spark, sf):
    return abt_table(spark, sf)


_KEYS5 = ["id", "dt_ref", "driverid", "year", "flchampion"]


@register("oot_split", _labels(
    "SELECT id, dt_ref, driverid, year, flchampion,"
    f" CASE WHEN year = {OOT_YEAR} THEN 'oot' ELSE 'analytics' END AS split"
    f" FROM abty WHERE year <= {OOT_YEAR}"))
def q_oot_split(spark, sf):
    analytics, oot = SP.oot_split(written_abt(spark, sf), OOT_YEAR)
    return (analytics.select(*_KEYS5, F.lit("analytics").alias("split"))
            .unionByName(oot.select(*_KEYS5, F.lit("oot").alias("split"))))


@register("season_dates", _labels("SELECT * FROM season_dates"))
def q_season_dates(spark, sf):
    analytics, _ = SP.oot_split(written_abt(spark, sf), OOT_YEAR)
    return SP.season_dates(analytics)


@register("season_tail_trim", _labels("SELECT * FROM trimmed"))
def q_season_tail_trim(spark, sf):
    return sampling(spark, sf)[2]


@register("driver_year_labels", _labels("SELECT * FROM units"))
def q_driver_year_labels(spark, sf):
    analytics, _ = SP.oot_split(written_abt(spark, sf), OOT_YEAR)
    return SP.driver_year_labels(analytics)


@register("stratified_split", _labels("SELECT * FROM split_units"))
def q_stratified_split(spark, sf):
    return sampling(spark, sf)[3]


@register("target_rates", _labels(
    "SELECT split, avg(flchampion) AS target_rate FROM split_units GROUP BY split"))
def q_target_rates(spark, sf):
    return MT.target_rates(sampling(spark, sf)[3])


@register("train_set", _labels(
    "SELECT id, dt_ref, driverid, year, flchampion FROM chosen WHERE split = 'train'"))
def q_train_set(spark, sf):
    return sampling(spark, sf)[4].select(*_KEYS5)


@register("test_set", _labels(
    "SELECT id, dt_ref, driverid, year, flchampion FROM chosen WHERE split = 'test'"))
def q_test_set(spark, sf):
    return sampling(spark, sf)[5].select(*_KEYS5)


_FEATS = FE.all_feature_names()

# Value used for missing features in training.
IMPUTE_VALUE = -1000.0


@register("missing_counts", _labels(
    "SELECT feature, n_missing FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _FEATS)
    + " FROM chosen WHERE split = 'train') ON COLUMNS(*) INTO NAME feature VALUE n_missing) AS u"
    " WHERE n_missing > 0"))
def q_missing_counts(spark, sf):
    return MT.missing_counts(train_features(spark, sf, ["dt_ref", "driverid"]), _FEATS)


@register("impute", _labels(
    "SELECT id, dt_ref, driverid, "
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), {IMPUTE_VALUE}) AS {c}" for c in _FEATS)
    + " FROM chosen WHERE split = 'train'"))
def q_impute(spark, sf):
    from ..operators.ml import fill_features
    keys = ["id", "dt_ref", "driverid"]
    return fill_features(train_features(spark, sf, keys), _FEATS, IMPUTE_VALUE).select(*keys, *_FEATS)


@register("auc_by_split", _labels(
    "SELECT split, SUM(pos * (nneg - cneg + 0.5 * neg)) / (MAX(npos) * MAX(nneg)) AS auc FROM ("
    " SELECT *, SUM(neg) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cneg,"
    " SUM(neg) OVER (PARTITION BY split) AS nneg, SUM(pos) OVER (PARTITION BY split) AS npos FROM ("
    " SELECT split, score, CAST(SUM(CASE WHEN flchampion = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,"
    " CAST(SUM(CASE WHEN flchampion = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg"
    " FROM scored GROUP BY split, score) AS c) AS k GROUP BY split"))
def q_auc_by_split(spark, sf):
    return MT.auc_by_split(scored_splits(spark, sf))


@register("roc_curve", _labels(
    "SELECT split, threshold, cneg / nneg AS fpr, cpos / npos AS tpr FROM ("
    " SELECT split, score AS threshold,"
    " SUM(neg) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cneg,"
    " SUM(pos) OVER (PARTITION BY split ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cpos,"
    " SUM(neg) OVER (PARTITION BY split) AS nneg, SUM(pos) OVER (PARTITION BY split) AS npos FROM ("
    " SELECT split, score, CAST(SUM(CASE WHEN flchampion = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,"
    " CAST(SUM(CASE WHEN flchampion = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg"
    " FROM scored GROUP BY split, score) AS c) AS k"))
def q_roc_curve(spark, sf):
    return MT.roc_curve(scored_splits(spark, sf))


# ------------------------------------------------------------ step 5: reporting

_REPORT_CTES = f""",
sc AS (SELECT *, CAST(year(dt_ref) AS INT) AS year,
         COALESCE(qtde_points_last_10 / (1 + qtde_points_life), 0) AS prob_win FROM fs_all),
names AS (
  SELECT driverid, fullname AS fullname_correct FROM (
    SELECT driverid, fullname, row_number() OVER (PARTITION BY driverid ORDER BY dt_ref, fullname) AS r
    FROM sc WHERE fullname IS NOT NULL) AS x WHERE r = 1),
named AS (SELECT sc.*, names.fullname_correct FROM sc JOIN names ON sc.driverid = names.driverid),
dlist AS (SELECT driverid, min(fullname_correct) AS fullname_correct FROM named GROUP BY driverid),
top3 AS (
  SELECT dt_ref, driverid, fullname_correct, prob_win FROM named
  WHERE dt_ref = (SELECT max(dt_ref) FROM named)
  ORDER BY prob_win DESC, driverid LIMIT 3),
defaults AS (SELECT * FROM dlist WHERE driverid IN (SELECT driverid FROM top3)),
filtered AS (
  SELECT * FROM named
  WHERE driverid IN (SELECT driverid FROM defaults) AND year IN (SELECT max(year) FROM named))"""


def _report(select: str) -> str:
    return f"WITH {OF.consolidated_ctes(YEAR_START, YEAR_STOP)}{_REPORT_CTES}\n{select}"


def scored_store(spark, sf, attributes=True):
    """The scored store with the columns that reports read, evaluated once."""
    store = features_all(spark, sf, [*_SCORE_FEATS, "qtd_sessions_last_10"], attributes)
    return written(SP.with_year(store).withColumn("prob_win", surrogate_score()), "scored")


def named_store(spark, sf):
    return RP.attach_names(scored_store(spark, sf))


def filtered_report(spark, sf, named=None):
    named = named_store(spark, sf) if named is None else named
    seasons = named.agg(F.max("year").alias("year"))
    return RP.report_filter(named, RP.default_drivers(named), seasons)


@register("canonical_names", _report("SELECT * FROM names"))
def q_canonical_names(spark, sf):
    return RP.canonical_names(scored_store(spark, sf))


@register("driver_list", _report("SELECT * FROM dlist"))
def q_driver_list(spark, sf):
    return RP.driver_list(named_store(spark, sf))


@register("season_list", _report("SELECT DISTINCT year FROM sc"))
def q_season_list(spark, sf):
    return RP.season_list(scored_store(spark, sf))


@register("top3_latest", _report("SELECT * FROM top3"))
def q_top3_latest(spark, sf):
    return RP.top3_latest(named_store(spark, sf))


@register("default_drivers", _report("SELECT * FROM defaults"))
def q_default_drivers(spark, sf):
    return RP.default_drivers(named_store(spark, sf))


@register("report_filter", _report(
    "SELECT id, dt_ref, driverid, year, fullname_correct, teamcolor, prob_win FROM filtered"))
def q_report_filter(spark, sf):
    return filtered_report(spark, sf).select(
        "id", "dt_ref", "driverid", "year", "fullname_correct", "teamcolor", "prob_win")


_COLOR_SQL = ("CASE WHEN teamcolor IS NULL OR teamcolor = '' THEN '#ffffff'"
              " WHEN length(teamcolor) = 7 THEN lower(teamcolor) ELSE '#' || lower(teamcolor) END")


@register("team_color", _report(f"SELECT driverid, dt_ref, teamcolor, {_COLOR_SQL} AS color FROM sc"))
def q_team_color(spark, sf):
    return scored_store(spark, sf).select(
        "driverid", "dt_ref", "teamcolor", SC.team_color(F.col("teamcolor")).alias("color"))


@register("driver_colors", _report(
    f"SELECT fullname_correct, color FROM (SELECT fullname_correct, {_COLOR_SQL} AS color,"
    " row_number() OVER (PARTITION BY fullname_correct ORDER BY dt_ref DESC,"
    f" {_COLOR_SQL} DESC) AS r FROM filtered) AS x WHERE r = 1"))
def q_driver_colors(spark, sf):
    return RP.driver_colors(filtered_report(spark, sf))


@register("prob_pivot", _report(
    "SELECT dt_ref, " + ", ".join(f"avg(CASE WHEN slot = {k} THEN prob_win END) AS driver_{k}" for k in (1, 2, 3))
    + " FROM filtered JOIN (SELECT driverid, row_number() OVER (ORDER BY fullname_correct, driverid) AS slot"
    " FROM defaults) AS s USING (driverid) GROUP BY dt_ref"))
def q_prob_pivot(spark, sf):
    named = named_store(spark, sf)
    slots = RP.driver_slots(RP.default_drivers(named))
    rows = filtered_report(spark, sf, named).join(slots, "driverid")
    wide = RP.prob_pivot(rows, [1, 2, 3], by="slot")
    return wide.select("dt_ref", *[F.col(str(k)).alias(f"driver_{k}") for k in (1, 2, 3)])


@register("attach_scores", _report(
    "SELECT sc.id, sc.dt_ref, sc.driverid, s.prob_win FROM sc LEFT JOIN"
    " (SELECT DISTINCT id, prob_win FROM sc WHERE year = (SELECT max(year) FROM sc)) AS s"
    " ON sc.id = s.id"))
def q_attach_scores(spark, sf):
    sc = scored_store(spark, sf, attributes=False)
    latest = sc.agg(F.max("year").alias("year"))
    scores = sc.join(latest, "year", "left_semi").select("id", "prob_win").distinct()
    return RP.attach_scores(sc.select("id", "dt_ref", "driverid"), scores)


@register("score_payload", _report(
    "SELECT dt_ref, id, key, CASE key WHEN '0' THEN 1 - prob_win ELSE prob_win END AS probability"
    " FROM (SELECT DISTINCT dt_ref, id, prob_win FROM sc) AS u, (VALUES ('0'), ('1')) AS k(key)"))
def q_score_payload(spark, sf):
    """Responses of about 1,000 ids per reference date, read back: the text keeps full precision."""
    from pyspark.sql import types as T
    sc = scored_store(spark, sf, attributes=False).select("dt_ref", "id", "prob_win").distinct()
    texts = RP.responses(sc, "dt_ref", "id", "prob_win")
    shape = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
    body = F.from_json("payload", T.StructType([T.StructField("predictions", shape)]))["predictions"]
    return (texts.select("dt_ref", F.explode(body).alias("id", "_p"))
            .select("dt_ref", "id", F.explode("_p").alias("key", "probability")))


_PAYLOAD_FEATS = ["qtde_points_last_10", "qtde_points_life", "qtd_sessions_last_10"]


@register("payload_records", _report(
    "SELECT id, " + ", ".join(_PAYLOAD_FEATS) + " FROM sc"))
def q_payload_records(spark, sf):
    from pyspark.sql import types as T
    sc = scored_store(spark, sf)
    rec = F.struct("id", *_PAYLOAD_FEATS)
    docs = sc.select(F.to_json(F.struct(F.array(rec).alias("values"))).alias("payload"))
    schema = T.StructType([T.StructField("id", T.StringType())]
                          + [T.StructField(c, sc.schema[c].dataType) for c in _PAYLOAD_FEATS])
    return docs.select(F.inline(SC.parse_records(F.col("payload"), schema)))


_BAD = "qtd_sessions_last_10 % 5"


@register("payload_rejects", _report(
    f"SELECT id, CASE {_BAD} WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'no values'"
    " WHEN 2 THEN 'qtde_points_life is no double' END AS reason,"
    f" CASE WHEN {_BAD} > 2 THEN qtde_points_life END AS qtde_points_life FROM sc"))
def q_payload_rejects(spark, sf):
    """Requests of which some are malformed: every record comes out, with its values or with the reason."""
    from pyspark.sql import types as T
    sc = scored_store(spark, sf, attributes=False).withColumn("_bad", F.expr(_BAD))
    good = F.to_json(F.struct(F.array(F.struct("id", "qtde_points_life")).alias("values")))
    text = (F.when(F.col("_bad") == 0, F.lit("{bad")).when(F.col("_bad") == 1, F.lit('{"rows": []}'))
            .when(F.col("_bad") == 2, F.lit('{"values": [{"id": "x", "qtde_points_life": "no"}]}')).otherwise(good))
    shape = T.StructType([T.StructField("id", T.StringType()), T.StructField("qtde_points_life", T.DoubleType())])
    asked = sc.select("id", text.alias("payload"))
    return RP.checked_records(asked, shape).select(
        "id", "reason", F.col("record")["qtde_points_life"].alias("qtde_points_life"))


# ------------------------------------------------------------ step 7: ingestion and sinks

from ..operators import ingest as IG  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources.tables import read_table  # noqa: E402
from ..sources.upsert import upsert  # noqa: E402
from ..streaming.ingest import ingest_landing, ingest_with_ledger, read_ledger  # noqa: E402
from ..streaming import online as OL  # noqa: E402
from ..streaming.repair import StoreRepair  # noqa: E402

_SR = f"WITH session_results AS ({OF.SESSION_RESULTS_SQL})"


@register("session_grid", f"{_SR}\nSELECT y.year, CAST(r.roundnumber AS INT) AS roundnumber, m.mode"
          " FROM (SELECT CAST(unnest(range(min(year), max(year) + 2)) AS INT) AS year FROM session_results) AS y,"
          " range(1, 30) AS r(roundnumber), (VALUES ('Race'), ('Sprint')) AS m(mode)")
def q_session_grid(spark, sf):
    """From the first landed season to the one after the last, which has no session yet."""
    return IG.session_grid(results(spark, sf), ahead=1)


@register("missing_sessions", f"{_SR},\n"
          "grid AS (SELECT y.year, CAST(r.roundnumber AS INT) AS roundnumber, m.mode"
          " FROM (SELECT DISTINCT year FROM session_results) AS y,"
          " range(1, 30) AS r(roundnumber), (VALUES ('Race'), ('Sprint')) AS m(mode)),"
          " have AS (SELECT DISTINCT year, roundnumber, mode FROM session_results)"
          " SELECT g.* FROM grid AS g WHERE NOT EXISTS (SELECT 1 FROM have AS h WHERE h.year = g.year"
          " AND h.roundnumber = g.roundnumber AND h.mode = g.mode)"
          " AND (g.mode = 'Race' OR EXISTS (SELECT 1 FROM have AS r WHERE r.year = g.year"
          " AND r.roundnumber = g.roundnumber AND r.mode = 'Race'))")
def q_missing_sessions(spark, sf):
    res = results(spark, sf)
    return IG.missing_sessions(IG.session_grid(res), res)


def event_context(spark, sf, res):
    """Event dimension per (year, round), derived from the given nation/region tables."""
    rounds = res.select("year", "roundnumber").distinct()
    # 25 nations and 5 regions by definition: fixed bounds, safe to broadcast
    nation = F.broadcast(read_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(read_table(spark, sf, "region").select("r_regionkey", "r_name"))
    ev = (rounds.join(nation, (F.col("year") * 12 + F.col("roundnumber")) % 25 == F.col("n_nationkey"))
          .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return ev.select("year", "roundnumber",
                     F.concat("n_name", F.lit(" GRAND PRIX "), F.col("year").cast("string"))
                     .alias("officialeventname"),
                     F.col("n_name").alias("country"), F.col("r_name").alias("location"))


_ENRICH_COLS = ["driverid", "year", "roundnumber", "mode", "points"]


@register("enrich_sessions", f"{_SR},\n"
          "ev AS (SELECT r.year, r.roundnumber, n_name || ' GRAND PRIX ' || CAST(r.year AS VARCHAR)"
          " AS officialeventname, n_name AS country, r_name AS location"
          " FROM (SELECT DISTINCT year, roundnumber FROM session_results) AS r"
          " JOIN nation ON (r.year * 12 + r.roundnumber) % 25 = n_nationkey"
          " JOIN region ON n_regionkey = r_regionkey)"
          " SELECT s.driverid, s.year, s.roundnumber, s.mode, s.points,"
          " ev.officialeventname, ev.country, ev.location"
          " FROM session_results AS s LEFT JOIN ev ON s.year = ev.year AND s.roundnumber = ev.roundnumber")
def q_enrich_sessions(spark, sf):
    res = results(spark, sf)
    return IG.enrich_sessions(res.select(*_ENRICH_COLS), event_context(spark, sf, res))


@register("session_file_name", f"{_SR},\n"
          "f AS (SELECT DISTINCT year, roundnumber, mode,"
          " 'data/raw/' || printf('%d_%02d_%s.parquet', year, roundnumber, substr(mode, 1, 1)) AS path"
          " FROM session_results)"
          " SELECT year, roundnumber, mode, path, regexp_extract(path, '[^/]+$') AS file,"
          " 'landed/' || regexp_extract(path, '[^/]+$') AS bucket_path FROM f")
def q_session_file_name(spark, sf):
    return IG.session_files(results(spark, sf))


@register("csv_roundtrip", _labels("SELECT * FROM abty"))
def q_csv_roundtrip(spark, sf):
    abt = abt_table(spark, sf)
    path = scratch_dir(spark, "abt-csv")
    FS.write_csv(abt, path, compression="gzip")
    return FS.read_csv(spark, path, abt.schema)


_CSV_COLS = ["id", "dt_ref", "qtd_sessions_life", "qtde_points_life"]


@register("csv_rejects", _labels(
    "SELECT CAST(qtd_sessions_life % 4 AS BIGINT) AS form, CASE WHEN qtd_sessions_life % 4 < 3 THEN 1 ELSE 0 END AS rejected,"
    " CAST(count(*) AS BIGINT) AS n_lines FROM abty GROUP BY ALL"))
def q_csv_rejects(spark, sf):
    """A CSV of which some lines are malformed: text in a number, a field too few, a field too many. None is lost."""
    abt = written_abt(spark, sf, _CSV_COLS[2:])
    form = F.col("qtd_sessions_life") % 4
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(FS.NULL_MARK)) for c in _CSV_COLS]
    line = (F.when(form == 0, F.concat_ws(";", *fields[:3], F.lit("no")))
            .when(form == 1, F.concat_ws(";", *fields[:3])).when(form == 2, F.concat_ws(";", *fields, F.lit("1")))
            .otherwise(F.concat_ws(";", *fields)))
    path = scratch_dir(spark, "csv-lines")
    abt.select(line.alias("value")).write.text(path)
    read = FS.read_csv_checked(spark, path, abt.select(*_CSV_COLS).schema, header=False)
    # a line that lacks its last field or has another there still has the field before it
    return read.groupBy((F.col("qtd_sessions_life") % 4).alias("form"), F.col(FS.REJECT).isNotNull().cast("int").alias("rejected")).agg(
        F.count("*").alias("n_lines"))


@register("publish_roundtrip", OF.consolidated_sql(YEAR_START, YEAR_STOP))
def q_publish_roundtrip(spark, sf):
    path = scratch_dir(spark, "fs-all")
    FS.publish(features_all(spark, sf), path)
    return FS.read_published(spark, path)


# The session group that lands late in the upsert scenario.
LATE_YEAR, LATE_MODE = 2000, "Sprint"


@register("upsert_features", OF.window_features_sql(YEAR_START, YEAR_STOP, 10000))
def q_upsert_features(spark, sf):
    """Career store built before a late batch of sessions landed, then repaired.

    Only reference dates on or after the first late session can change; those
    rows are recomputed from all sessions and merged on (dt_ref, driverid).
    """
    res = sessions(spark, sf)
    late = (F.col("year") == LATE_YEAR) & (F.col("mode") == LATE_MODE)
    early = res.where(~late)
    first_late = res.where(late).agg(F.min(F.to_date("date")).alias("d0"))
    table = scratch_dir(spark, "fs-life")
    part = F.year("dt_ref").alias("dt_year")
    before = FE.window_features(early, YEAR_START, YEAR_STOP, None)
    before.select("*", part).write.mode("overwrite").partitionBy("dt_year").parquet(table)
    dates = asof.dim_dates(res, YEAR_START, YEAR_STOP)
    later = dates.join(F.broadcast(first_late), F.col("dt_ref") >= F.col("d0")).select("dt_ref").distinct()
    redo = FE.window_features(res, YEAR_START, YEAR_STOP, None, dates=later)
    # the year follows from the date: as part of the key it says which partitions to read
    upsert(spark, table, redo.select("*", part), ["dt_ref", "driverid", "dt_year"], "dt_year")
    return spark.read.parquet(table).drop("dt_year")


@register("stream_ingest", OF.SESSION_RESULTS_SQL)
def q_stream_ingest(spark, sf):
    """Session files land in three groups; a stream merges them into bronze."""
    res = sessions(spark, sf)
    root = scratch_dir(spark, "ingest")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    # a dozen files a group in order of their rounds, whatever their size: the number of batches does not grow
    for cond in (F.col("year") <= 1996, F.col("year").between(1997, 1999), F.col("year") >= 2000):
        res.where(cond).repartitionByRange(12, "year", "roundnumber", "mode").write.mode("append").parquet(landing)
    ingest_landing(spark, landing, bronze, f"{root}/checkpoint", max_files_per_trigger=4)
    return spark.read.parquet(bronze).select(*res.columns)


@register("ingest_ledger", f"{_SR}\nSELECT ok, CAST(count(*) AS BIGINT) AS n_rows,"
          " CAST(sum(CASE WHEN ok THEN 0 ELSE CAST(mode = 'Sprint' AS INT) END) AS BIGINT) AS n_bad,"
          " CAST(CASE WHEN ok THEN 0 ELSE 1 END AS BIGINT) AS files_left"
          " FROM (SELECT *, year <> 1996 AS ok FROM session_results) AS s GROUP BY ok")
def q_ingest_ledger(spark, sf):
    """Files land with a ledger row each; a file with rows that lack a driver stays where it is."""
    res = sessions(spark, sf)
    root = scratch_dir(spark, "ledger")
    landing, ledger = f"{root}/landing", f"{root}/ledger"
    res.where("year <> 1996").write.parquet(landing)
    broken = res.where("year = 1996").withColumn("driverid", F.expr("CASE WHEN mode <> 'Sprint' THEN driverid END"))
    broken.coalesce(1).write.mode("append").parquet(landing)
    ingest_with_ledger(spark, landing, f"{root}/bronze", ledger, f"{root}/checkpoint", max_files_per_trigger=100)
    left = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(landing)
            .agg(F.count("path").alias("left_there")))
    per = read_ledger(spark, ledger).groupBy("ok").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))
    # one row: the number of files that are left
    return per.join(F.broadcast(left), F.lit(True)).select(
        "ok", "n_rows", "n_bad", F.when(F.col("ok"), F.lit(0)).otherwise(F.col("left_there")).cast("long").alias("files_left"))


@register("online_features", f"WITH newest AS ({OF.window_features_sql(YEAR_START, YEAR_STOP, LAST_N)})"
          " SELECT * FROM newest WHERE dt_ref = (SELECT max(dt_ref) FROM newest)")
def q_online_features(spark, sf):
    """Features at the newest date from keyed state, after sessions landed in an order that has nothing to do with time."""
    res = results(spark, sf)
    root = scratch_dir(spark, "online")
    res.repartition(3, F.xxhash64("driverid", "year", "roundnumber", "mode", F.lit(7))).write.parquet(f"{root}/landing")
    OL.follow(spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint")
    return OL.online_features(spark, f"{root}/table", YEAR_START, YEAR_STOP, LAST_N)


@register("repaired_store", OF.consolidated_sql(YEAR_START, YEAR_STOP))
def q_repaired_store(spark, sf):
    """The consolidated store after all sessions landed in three batches that are out of order, repaired
    after each: the last brings whole rounds that move the windows of all drivers."""
    res = sessions(spark, sf)
    held = "year = 1998 AND roundnumber IN (3, 4)"
    late = f"year = {LATE_YEAR} AND mode = '{LATE_MODE}'"
    keeper = StoreRepair(spark, scratch_dir(spark, "repair"), YEAR_START, YEAR_STOP)
    for batch_id, cond in enumerate((f"NOT ({held}) AND NOT ({late})", late, held)):
        keeper.merge(res.where(cond), batch_id)
    return keeper.read()


# ------------------------------------------------------------ step 6: models (rows-only checks)

from ..operators import ml as ML  # noqa: E402

# Model settings of the reference (500 trees, leaves of 50,
# seed 42; 500 boosting rounds at learning rate 0.001).
MODELS = {
    "ada_boost": lambda: ML.AdaBoostStumps(numRounds=500, learningRate=0.001, labelCol="label"),
    "random_forest": lambda: ML.random_forest(label="label", trees=500, min_leaf=50, seed=42),
}


def _with_label(df):
    return df.withColumn("label", F.col("flchampion").cast("double"))


def model_rows(spark, sf):
    """Train, test and OOT rows with their split, written once for all models."""
    res = sessions(spark, sf)
    _, oot, _, _, train, test = sampling(spark, sf, res=res)
    train, test, oot = (rows.select(*_KEYS5, F.lit(split).alias("split"))
                        for split, rows in (("train", train), ("test", test), ("oot", oot)))
    chosen = train.unionByName(test).unionByName(oot)
    return written(_with_label(FE.features_of(res, chosen, YEAR_START, YEAR_STOP)), "splits")


def fit_and_score(rows, model_name):
    """Fit on the train split; score train, test and OOT. The scores are written
    once, so reading them does not fit again."""
    model = ML.pipeline(_FEATS, MODELS[model_name]()).fit(rows.where("split = 'train'"))
    scored = ML.probability_of_win(model.transform(rows))
    return model, written(scored.select("id", "dt_ref", "driverid", "split", "flchampion", "prob_win"), "scores")


@register("rf_scores")
def q_rf_scores(spark, sf):
    return fit_and_score(model_rows(spark, sf), "random_forest")[1]


@register("adaboost_scores")
def q_adaboost_scores(spark, sf):
    return fit_and_score(model_rows(spark, sf), "ada_boost")[1]


# Features and settings of the boosting check.
BOOST_FEATS = ["qtd_sessions_life", "qtde_points_life", "avg_position_life", "qtde_points_last_10",
               "avg_gridposition_last_20", "qtde_1pos_last_40"]
BOOST_ROUNDS, BOOST_RATE = 5, 0.8


def _boosting_sql() -> str:
    """Rounds as SQL: weighted class counts of each value, their running sums, the purest midpoint, new weights."""
    pairs = ", ".join(f"{{'j': {j}, 'v': COALESCE(CAST({c} AS DOUBLE), {IMPUTE_VALUE})}}" for j, c in enumerate(BOOST_FEATS))
    ctes = [f"""base AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY id) AS rid, flchampion AS y, [{pairs}] AS xs FROM chosen WHERE split = 'train'),
cells AS MATERIALIZED (SELECT rid, y, x.j AS j, x.v AS v FROM (SELECT rid, y, unnest(xs) AS x FROM base) AS u),
w1 AS MATERIALIZED (SELECT rid, y, CAST(1 AS DOUBLE) AS w FROM base)"""]
    for k in range(1, BOOST_ROUNDS + 1):
        ctes.append(f"""values{k} AS (
  SELECT j, v, COALESCE(sum(w) FILTER (c.y = 0), 0) AS n0, COALESCE(sum(w) FILTER (c.y = 1), 0) AS n1
  FROM cells AS c JOIN w{k} USING (rid) GROUP BY j, v),
sides{k} AS (
  SELECT j, v / 2 + lead(v) OVER o / 2 AS threshold, sum(n0) OVER o AS l0, sum(n1) OVER o AS l1,
    sum(n0) OVER (PARTITION BY j) - sum(n0) OVER o AS r0, sum(n1) OVER (PARTITION BY j) - sum(n1) OVER o AS r1
  FROM values{k} WINDOW o AS (PARTITION BY j ORDER BY v)),
stump{k} AS MATERIALIZED (
  SELECT *, CAST(l1 > l0 AS INT) AS left_class, CAST(r1 > r0 AS INT) AS right_class,
    (least(l0, l1) + least(r0, r1)) / (l0 + l1 + r0 + r1) AS err
  FROM sides{k} WHERE threshold IS NOT NULL
  ORDER BY round((l0 + l1 - (l0 * l0 + l1 * l1) / (l0 + l1) + r0 + r1 - (r0 * r0 + r1 * r1) / (r0 + r1))
                 / (l0 + l1 + r0 + r1), 12), j, threshold LIMIT 1),
w{k + 1} AS MATERIALIZED (
  SELECT rid, c.y, w * CASE WHEN CASE WHEN v <= threshold THEN left_class ELSE right_class END <> c.y
    THEN exp({BOOST_RATE} * ln((1 - err) / err)) ELSE 1 END AS w
  FROM cells AS c JOIN w{k} USING (rid) JOIN stump{k} USING (j))""")
    names = " ".join(f"WHEN {j} THEN '{c}'" for j, c in enumerate(BOOST_FEATS))
    rounds = " UNION ALL ".join(f"SELECT {k} AS round, * FROM stump{k}" for k in range(1, BOOST_ROUNDS + 1))
    return (",\n" + ",\n".join(ctes) + f"\nSELECT CAST(round AS INT) AS round, CASE j {names} END AS feature, threshold,"
            f" left_class, right_class, {BOOST_RATE} * ln((1 - err) / err) AS alpha FROM ({rounds}) AS r")


@register("adaboost_rounds", f"WITH {_LABEL_CTES}{_boosting_sql()}")
def q_adaboost_rounds(spark, sf):
    """The stumps of five boosting rounds on the train split, with every threshold tried."""
    # the learner writes its rows itself
    train = _with_label(sampling(spark, sf, BOOST_FEATS)[4]).select("label", *BOOST_FEATS)
    boost = ML.AdaBoostStumps(numRounds=BOOST_ROUNDS, learningRate=BOOST_RATE)
    return ML.boosting_rounds(ML.pipeline(BOOST_FEATS, boost, IMPUTE_VALUE).fit(train), BOOST_FEATS, spark)


@register("feature_importance")
def q_feature_importance(spark, sf):
    rows = model_rows(spark, sf)
    fits = fit_all(rows, MODELS)
    out = None
    for name, (model, _) in fits.items():
        fi = ML.feature_importance(model, _FEATS, spark).withColumn("model", F.lit(name))
        out = fi if out is None else out.unionByName(fi)
    path = scratch_dir(spark, "importance")
    ML.write_importance(out, path)
    return spark.read.parquet(path)


def fit_all(rows, names):
    """Every model fitted and scored, at the same time: {name: (model, scores)}."""
    with ThreadPoolExecutor(len(names)) as pool:
        run = inheritable_thread_target(rows.sparkSession)(lambda name: fit_and_score(rows, name))
        return dict(zip(names, pool.map(run, names)))


def _metrics(fits):
    out = None
    for name, (_, scored) in fits.items():
        auc = MT.auc_by_split(scored, score="prob_win").withColumn("model", F.lit(name))
        out = auc if out is None else out.unionByName(auc)
    return out


@register("model_metrics")
def q_model_metrics(spark, sf):
    return _metrics(fit_all(model_rows(spark, sf), MODELS))


@register("run_log")
def q_run_log(spark, sf):
    """Parameters and metrics of each model run, appended to a log table."""
    path = scratch_dir(spark, "run-log")
    for name in MODELS:
        est = MODELS[name]()
        params = [(name, "param", p.name, str(v)) for p, v in est.extractParamMap().items()]
        params += [(name, "param", "imputation_strategy", "arbitrary"),
                   (name, "param", "imputation_value", str(IMPUTE_VALUE))]
        spark.createDataFrame(params, "run string, kind string, key string, value string") \
            .write.mode("append").parquet(path)
    m = _metrics(fit_all(model_rows(spark, sf), MODELS)).select(
        F.col("model").alias("run"), F.lit("metric").alias("kind"), F.concat(F.lit("auc_"), F.col("split")).alias("key"),
        F.col("auc").cast("string").alias("value"))
    m.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("batch_scores")
def q_batch_scores(spark, sf):
    """Fit the models, take the one with the best out-of-time AUC (T17), refit it on every ABT row (M11),
    register it (S15, S20), load the newest version (S16, S19), score the whole store (M12)."""
    from pyspark.ml import PipelineModel
    from ..sources.registry import latest_model, register_model
    best = ML.best_model(_metrics(fit_all(model_rows(spark, sf), MODELS)))
    store = written(features_all(spark, sf), "store")
    abt = LB.abt(store, champions(spark, sf), ABT_START, ABT_STOP)
    analytics, oot = SP.oot_split(abt, OOT_YEAR)
    model = ML.pipeline(_FEATS, MODELS[best]()).fit(written(_with_label(analytics.unionByName(oot)), "full"))
    registry = scratch_dir(spark, "registry")
    register_model(registry, model, "season_title", scratch_dir(spark, "models"), spark)
    newest = latest_model(spark.read.parquet(registry), "season_title").first()
    loaded = PipelineModel.load(newest["path"])
    return ML.probability_of_win(loaded.transform(store)).select("id", "dt_ref", "driverid", "prob_win", F.lit(best).alias("model"))
