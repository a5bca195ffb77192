"""Literal SQL of the feature definitions, for the DuckDB oracle.

These texts state the definitions by membership and counting (what is known at
a date, rounds ranked by how many later ones are seen, eligibility by existence,
four stores on common keys), independently of the Spark operators, so the oracle
tests the rewrites in :mod:`asofstore.operators`.
DuckDB returns integer sums as HUGEINT; they are cast to BIGINT.
"""

from __future__ import annotations

# The rule deriving session results from lineitem, supplier and
# nation (FIXTURES.md section 2).
SESSION_RESULTS_SQL = """
SELECT 'd' || CAST(k AS VARCHAR(20)) || '-' || CAST(era AS VARCHAR(20)) AS driverid, yr AS year,
  rnd AS roundnumber, md AS mode,
  CAST(make_date(yr, CASE WHEN yr % 2 = 0 AND rnd IN (5, 7) THEN 12 - rnd ELSE rnd END,
                 CASE WHEN md = 'Sprint' THEN 14 ELSE 28 END) AS TIMESTAMP) AS date,
  CAST(p AS DOUBLE) AS position, CAST(g AS DOUBLE) AS gridposition,
  CASE WHEN p <= 10 THEN dc / CAST(4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS points,
  CASE WHEN p IS NULL THEN 'Retired' WHEN st = 'F' THEN 'Finished'
       WHEN dmax > 0.05 THEN '+1 Lap' ELSE 'Lapped' END AS status,
  CASE WHEN rnd % 5 = 0 THEN upper(full_name) ELSE full_name END AS fullname, n_name AS teamname,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN hue ELSE '#' || hue END AS teamcolor
FROM (
  SELECT t.*, n_name, upper(substr(md5(n_name), 1, 6)) AS hue, s_name || ' ' || CAST(era AS VARCHAR(20)) AS full_name
  FROM (
    SELECT k, yr, rnd, md, dc, dmax, st, CAST(floor((yr + k) / 3.0) AS BIGINT) AS era,
      NULLIF((ok * 3 + ln * 5) % 22, 0) AS p, NULLIF((ok * 7 + ln) % 23, 22) AS g
    FROM (
      SELECT l_suppkey AS k, CAST(year(l_shipdate) AS INT) AS yr, CAST(month(l_shipdate) AS INT) AS rnd,
        CASE l_returnflag WHEN 'A' THEN 'Race' WHEN 'R' THEN 'Sprint' ELSE 'Other' END AS md,
        CAST(sum(l_orderkey) AS BIGINT) AS ok, CAST(sum(l_linenumber) AS BIGINT) AS ln,
        CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS dc,
        max(l_discount) AS dmax, min(l_linestatus) AS st
      FROM lineitem GROUP BY 1, 2, 3, 4) AS sums) AS t
  JOIN supplier ON k = s_suppkey JOIN nation ON s_nationkey = n_nationkey) AS named
"""

# The 43 feature aggregates as SQL, in output order.
_FINISHED = "(status = 'Finished' OR status LIKE '+%')"
_COUNTS = {
    "qtde_sessions_finished": _FINISHED,
    "qtde_1pos": "position = 1",
    "qtde_podios": "position <= 3",
    "qtde_pos5": "position <= 5",
    "qtde_gridpos5": "gridposition <= 5",
    "qtde_1_gridposition": "gridposition = 1",
    "qtde_pole_win": "gridposition = 1 AND position = 1",
    "qtd_sessions_with_points": "points > 0",
    "qtde_sessions_with_overtake": "position < gridposition",
}
_SUMS = {"qtde_points": "points"}
_AVGS = {"avg_gridposition": "gridposition", "avg_position": "position",
         "avg_overtake": "gridposition - position"}
_ORDER = ["qtde_sessions_finished", "qtde_1pos", "qtde_podios", "qtde_pos5", "qtde_gridpos5",
          "qtde_points", "avg_gridposition", "avg_position", "qtde_1_gridposition",
          "qtde_pole_win", "qtd_sessions_with_points", "qtde_sessions_with_overtake",
          "avg_overtake"]
_MODES = [("", None), ("_race", "Race"), ("_sprint", "Sprint")]


def feature_aggregates_sql() -> list[str]:
    out = ["CAST(count(DISTINCT year) AS BIGINT) AS qtd_seasons",
           "CAST(count(*) AS BIGINT) AS qtd_sessions",
           "CAST(sum(CASE WHEN mode = 'Race' THEN 1 ELSE 0 END) AS BIGINT) AS qtd_race",
           "CAST(sum(CASE WHEN mode = 'Sprint' THEN 1 ELSE 0 END) AS BIGINT) AS qtd_sprint"]
    for fam in _ORDER:
        for suf, mode in _MODES:
            mc = "" if mode is None else f"mode = '{mode}' AND "
            if fam in _COUNTS:
                out.append(f"CAST(sum(CASE WHEN {mc}({_COUNTS[fam]}) THEN 1 ELSE 0 END) AS BIGINT) AS {fam}{suf}")
            elif fam in _SUMS:
                v = _SUMS[fam] if mode is None else f"CASE WHEN mode = '{mode}' THEN {_SUMS[fam]} END"
                out.append(f"sum({v}) AS {fam}{suf}")
            else:
                v = _AVGS[fam] if mode is None else f"CASE WHEN mode = '{mode}' THEN {_AVGS[fam]} END"
                out.append(f"avg({v}) AS {fam}{suf}")
    return out


FEATURE_COLUMNS = [e.rsplit(" AS ", 1)[1] for e in feature_aggregates_sql()]


def base_ctes(year_start: int, year_stop: int, year_lag: int = 2) -> str:
    """The relations that the definitions speak of, each by its own property:
    a round is seen at a date if it has begun, its place is one more than the
    number of later rounds seen; a driver is eligible if a recent session exists."""
    return f"""
session_results AS ({SESSION_RESULTS_SQL}),
days AS (SELECT *, CAST(date AS DATE) AS day FROM session_results),
dim_dates AS (
  SELECT day AS dt_ref, year AS ref_year FROM days
  WHERE year BETWEEN {year_start} AND {year_stop} GROUP BY ALL),
past_sessions AS (
  SELECT c.dt_ref, c.ref_year, d.* FROM days AS d, dim_dates AS c WHERE d.day <= c.dt_ref),
begun AS (SELECT year, roundnumber, min(day) AS first_day FROM days GROUP BY year, roundnumber),
distinct_rounds AS (
  SELECT c.dt_ref, b.year, b.roundnumber
  FROM (SELECT dt_ref FROM dim_dates GROUP BY dt_ref) AS c, begun AS b WHERE b.first_day <= c.dt_ref),
ranked_rounds AS (
  SELECT a.dt_ref, a.year, a.roundnumber, 1 + count(b.year) AS rn
  FROM distinct_rounds AS a LEFT JOIN distinct_rounds AS b
    ON b.dt_ref = a.dt_ref AND (b.year > a.year OR (b.year = a.year AND b.roundnumber > a.roundnumber))
  GROUP BY ALL),
eligible_drivers AS (
  SELECT c.dt_ref, d.driverid FROM dim_dates AS c, days AS d
  WHERE d.day <= c.dt_ref AND d.year >= c.ref_year - {year_lag} GROUP BY ALL)"""


def window_stats_cte(name: str, last_rounds: int) -> str:
    """Features of one window: what is known at a date, kept by membership."""
    aggs = ",\n    ".join(feature_aggregates_sql())
    return f"""
{name} AS (
  SELECT dt_ref, driverid,
    {aggs}
  FROM past_sessions AS p
  WHERE (p.dt_ref, p.driverid) IN (SELECT (dt_ref, driverid) FROM eligible_drivers)
    AND (p.dt_ref, p.year, p.roundnumber) IN (
      SELECT (dt_ref, year, roundnumber) FROM ranked_rounds WHERE rn <= {last_rounds})
  GROUP BY ALL)"""


def window_features_sql(year_start: int, year_stop: int, last_rounds: int) -> str:
    return (f"WITH {base_ctes(year_start, year_stop)},"
            f"{window_stats_cte('features', last_rounds)}\nSELECT * FROM features")


def consolidated_ctes(year_start: int, year_stop: int) -> str:
    """CTE list (without WITH) ending in ``fs_all``: the consolidated store."""
    windows = [("life", 10000), ("last_10", 10), ("last_20", 20), ("last_40", 40)]
    ctes = ",".join(window_stats_cte(f"store_{w}", n) for w, n in windows)
    cols = ",\n  ".join(f"store_{w}.{c} AS {c}_{w}" for w, _ in windows for c in FEATURE_COLUMNS)
    joins = "\n  ".join(f"JOIN store_{w} USING (dt_ref, driverid)" for w, _ in windows[1:])
    return f"""{base_ctes(year_start, year_stop)},{ctes},
fs_all AS (
  SELECT strftime(dt_ref, '%Y-%m-%d') || '_' || driverid AS id, dt_ref, driverid,
  {cols},
  fullname, teamname, teamcolor
  FROM store_{windows[0][0]}
  {joins}
  LEFT JOIN (SELECT driverid, day AS dt_ref, fullname, teamname, teamcolor FROM days) AS about
    USING (dt_ref, driverid))"""


def consolidated_sql(year_start: int, year_stop: int, select_tail: str = "") -> str:
    """Four window stores on common keys, with the attributes of the day."""
    return f"WITH {consolidated_ctes(year_start, year_stop)}\n{select_tail or 'SELECT * FROM fs_all'}"
