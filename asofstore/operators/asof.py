"""Point-in-time building blocks: reference dates, rounds seen, eligibility.

Reference dates are session dates; at a reference date ``dt_ref`` every
session dated on or before it is known (sessions on ``dt_ref`` itself count).
A *round* is ``(year, roundnumber)``; "the last N rounds" at ``dt_ref`` are
the N greatest ``(year, roundnumber)`` among rounds with at least one session
on or before ``dt_ref`` -- ranked by season and round number, never by date,
so rounds held out of date order keep their place.

Scale notes. The literal form of these definitions is a range join of every
reference date with every earlier session (fan-out grows with history). Here
everything that is joined against the sessions is first reduced to
calendar-sized maps: reference dates (at most 366 per season in range),
rounds (one row per season round) and their product. The broadcast side is
always one whose row bound follows from the season range alone (dates, and
dates x a bounded number of rounds or seasons), never from the number of
drivers or sessions; the bound is checked before the hint, and beyond it the
plan falls back to a shuffle join sized by AQE. Per-driver tables are reduced with map-side
combining aggregates before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Broadcast a calendar map only when its analytical bound is below this many
# bytes, at 64 bytes a row (a few longs and dates as they are held in memory).
MAX_BROADCAST_MAP_BYTES = 64 << 20
MAP_ROW_BYTES = 64


def with_session_date(results: DataFrame) -> DataFrame:
    """Add ``d``: the session timestamp truncated to a date (F1); a NaN measure
    becomes NULL, wherever the rows come from (T20)."""
    if "d" in results.columns:
        return results
    kinds = dict(results.dtypes)
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in ("position", "gridposition", "points")
             if kinds.get(c) in ("double", "float")}
    return results.withColumns({**clean, "d": F.to_date("date")})


def _in_years(col, year_start, year_stop):
    cond = F.lit(True)
    if year_start is not None:
        cond = cond & (col >= F.lit(year_start))
    if year_stop is not None:
        cond = cond & (col <= F.lit(year_stop))
    return cond


def dim_dates(results: DataFrame, year_start: int | None = None,
              year_stop: int | None = None) -> DataFrame:
    """Distinct ``(dt_ref, ref_year)`` of sessions in an inclusive season range."""
    s = with_session_date(results)
    return (s.where(_in_years(F.col("year"), year_start, year_stop))
             .select(F.col("d").alias("dt_ref"), F.col("year").alias("ref_year"))
             .distinct())


def date_bound(year_start: int | None, year_stop: int | None) -> int | None:
    """Calendar upper bound on the number of reference dates, if the range is closed."""
    if year_start is None or year_stop is None:
        return None
    return max(0, year_stop - year_start + 1) * 366


def maybe_broadcast(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Broadcast ``df`` only when its proven row bound is small enough.

    Without a bound the optimizer decides from statistics (and AQE from
    runtime sizes), which keeps a shuffle join available for large inputs.
    """
    if row_bound is not None and row_bound * MAP_ROW_BYTES <= MAX_BROADCAST_MAP_BYTES:
        return F.broadcast(df)
    return df


def by_exchange(df: DataFrame) -> DataFrame:
    """``df`` as a join side whose rows grow with drivers or sessions: never broadcast.

    The optimizer guesses a written table's size from its files, in which keys are packed to a few bytes a row; as a
    broadcast they are some hundred bytes a row and all of them pass through the driver.
    """
    return df.hint("merge")


def round_first_dates(results: DataFrame) -> DataFrame:
    """One row per round with the date of its first session."""
    s = with_session_date(results)
    return s.groupBy("year", "roundnumber").agg(F.min("d").alias("first_d"))


def rounds_at_dates(results: DataFrame, year_start: int | None = None, year_stop: int | None = None) -> DataFrame:
    """``(dt_ref, rounds)``: the rounds seen at each date as an array of (year, roundnumber, first_d), newest first.

    A round is seen at ``dt_ref`` when its first session is on or before it, which is the same set as the distinct
    rounds of all earlier sessions. Sessions are read once: the calendar, a row per round with its days, becomes one
    row whose days are laid out again, and each date filters its rounds. No join, whether or not the range is closed.
    """
    s = with_session_date(results)
    rounds = s.groupBy("year", "roundnumber").agg(
        F.min("d").alias("first_d"), F.collect_set(F.struct("d")).alias("days"))
    calendar = rounds.agg(
        F.sort_array(F.collect_list(F.struct("year", "roundnumber", "first_d")), asc=False).alias("_all"),
        F.array_distinct(F.flatten(F.collect_list(F.when(_in_years(F.col("year"), year_start, year_stop), F.col("days"))))).alias("_days"))
    return calendar.select("_all", F.inline("_days").alias("dt_ref")).select(
        "dt_ref", F.filter("_all", lambda r: r["first_d"] <= F.col("dt_ref")).alias("rounds"))


def ranked_rounds(results: DataFrame, year_start: int | None = None,
                  year_stop: int | None = None, n: int | None = None) -> DataFrame:
    """``(dt_ref, year, roundnumber, rn)``: rounds seen at each date, newest first (W1); the first ``n`` where given."""
    seen = rounds_at_dates(results, year_start, year_stop)
    if n is not None:
        seen = seen.withColumn("rounds", F.slice("rounds", 1, n))
    return seen.select("dt_ref", F.posexplode("rounds").alias("rn", "r")).select(
        "dt_ref", F.col("r.year").alias("year"), F.col("r.roundnumber").alias("roundnumber"), (F.col("rn") + 1).alias("rn"))


def distinct_rounds(results: DataFrame, year_start: int | None = None,
                    year_stop: int | None = None) -> DataFrame:
    """Distinct ``(dt_ref, year, roundnumber)`` of sessions known at each date."""
    return ranked_rounds(results, year_start, year_stop).drop("rn")


def last_rounds(results: DataFrame, year_start: int | None = None,
                year_stop: int | None = None, n: int | None = 10) -> DataFrame:
    """Rounds ranked ``rn <= n`` at each date (P7); ``n=None`` keeps all."""
    return ranked_rounds(results, year_start, year_stop, n)


def driver_seasons(results: DataFrame) -> DataFrame:
    """``(driverid, year, first_d)``: a driver's first session date per season.

    Aggregated with map-side combining, so a driver holding a large share of
    all rows still leaves one row per season per task before the shuffle.
    """
    s = with_session_date(results)
    return s.groupBy("driverid", "year").agg(F.min("d").alias("first_d"))


def known_dates(results: DataFrame, year_start: int | None = None, year_stop: int | None = None, year_lag: int = 2) -> DataFrame:
    """``(driverid, _known)``: the reference dates at which a driver is eligible (:func:`eligible_drivers`), as an array."""
    dates = dim_dates(results, year_start, year_stop).where("dt_ref IS NOT NULL AND ref_year IS NOT NULL")
    calendar = dates.agg(F.collect_list(F.struct("dt_ref", "ref_year"))).scalar()
    seasons = driver_seasons(results).groupBy("driverid").agg(F.collect_list(F.struct("year", "first_d")).alias("_seasons"))
    fits = lambda t: F.exists("_seasons", lambda s: (s["first_d"] <= t["dt_ref"])
                              & (s["year"] >= t["ref_year"] - F.lit(year_lag)))
    return seasons.withColumn("_dates", calendar).select(
        "driverid", F.array_distinct(F.transform(F.filter("_dates", fits), lambda t: t["dt_ref"])).alias("_known"))


def eligible_drivers(results: DataFrame, year_start: int | None = None,
                     year_stop: int | None = None, year_lag: int = 2, with_mult: bool = False) -> DataFrame:
    """``(dt_ref, driverid)`` with a known session in a season ``>= ref_year - year_lag``.

    Literal form: any session on or before ``dt_ref`` with
    ``ref_year - year <= year_lag``. A driver-season qualifies exactly when
    its first session is on or before ``dt_ref``, so a driver needs its seasons
    with their first dates only: they become one row per driver, which filters
    the calendar (a scalar subquery: an array of the reference dates with their seasons)
    and lays out the dates that qualify. Nothing is exchanged but driver-seasons,
    and no date is made twice for a driver, so there is nothing to make distinct.

    ``with_mult`` adds ``mult``, the driver's sessions on that very day (null: none): its days become
    one map per driver, looked up while the dates are laid out, so these are not exchanged for it.
    """
    known = known_dates(results, year_start, year_stop, year_lag)
    if with_mult:
        per_day = with_session_date(results).where("d IS NOT NULL").groupBy("driverid", "d").agg(F.count("*").alias("mult"))
        days = per_day.groupBy("driverid").agg(F.map_from_entries(F.collect_list(F.struct("d", "mult"))).alias("_days"))
        out = known.join(days, "driverid", "left").select(F.explode("_known").alias("dt_ref"), "driverid", "_days")
        return out.select("dt_ref", "driverid", F.try_element_at("_days", F.col("dt_ref")).alias("mult"))
    return known.select(F.explode("_known").alias("dt_ref"), "driverid")


def sessions_known_at(results: DataFrame, year_start: int | None = None,
                      year_stop: int | None = None) -> DataFrame:
    """Per reference date: number of sessions, and their points, known at it (J1 as counts).

    Sessions are first reduced to one row per date; running sums over the
    calendar's dates answer every reference date, linear in the history. The
    window reads a row per date and reference season.
    """
    s = with_session_date(results)
    per_day = (s.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("p"))
               .select(F.col("d").alias("t"), "n", "p", F.lit(1).alias("k"), F.lit(0).alias("phase")))
    dates = dim_dates(results, year_start, year_stop).select(F.col("dt_ref").alias("t"), "ref_year",
                                                             F.lit(1).alias("phase"))
    w = Window.partitionBy(F.lit(0)).orderBy("t", "phase").rowsBetween(Window.unboundedPreceding, 0)
    rows = per_day.unionByName(dates, allowMissingColumns=True)
    return (rows.select("t", "ref_year", "phase", F.sum("n").over(w).alias("n_sessions"),
                        F.sum("p").over(w).alias("sum_points"), F.sum("k").over(w).cast("long").alias("n_session_dates"))
            .where("phase = 1").select(F.col("t").alias("dt_ref"), "ref_year", "n_sessions", "sum_points",
                                       "n_session_dates"))


def round_window_map(results: DataFrame, year_start: int | None, year_stop: int | None,
                     max_rounds: int) -> DataFrame:
    """``(dt_ref, year, roundnumber, rn, yk)`` with ``rn <= max_rounds``, broadcast when bounded.

    ``yk`` numbers the seasons inside the window of each date (1 = newest), so
    ``yk <= max_rounds``; it lets distinct seasons be counted with a bit set.
    """
    m = last_rounds(results, year_start, year_stop, max_rounds)
    m = m.withColumn("yk", F.dense_rank().over(
        Window.partitionBy("dt_ref").orderBy(F.col("year").desc())))
    bound = date_bound(year_start, year_stop)
    return maybe_broadcast(m, None if bound is None else bound * max_rounds)


def sessions_in_last_rounds(results: DataFrame, year_start: int | None = None,
                            year_stop: int | None = None, n: int = 10) -> DataFrame:
    """Session rows fanned out to each reference date whose last ``n`` rounds hold them.

    Equi-join on the round with the residual ``session date <= dt_ref`` (on
    the day a sprint is run its round is already counted, the race later in
    the round is not yet known). The fan-out per session is bounded by the
    reference dates of ``n`` rounds.
    """
    s = with_session_date(results)
    m = round_window_map(results, year_start, year_stop, n)
    return s.join(m, ["year", "roundnumber"]).where(F.col("d") <= F.col("dt_ref"))


def eligible_results(results: DataFrame, year_start: int | None = None,
                     year_stop: int | None = None, n: int = 10,
                     year_lag: int = 2) -> DataFrame:
    """Past sessions of eligible drivers inside the last ``n`` rounds.

    Literal form: the sessions are fanned out to the dates whose last rounds hold them, and dates at which their driver
    is not eligible go. Here the dates of a round are one array and those of a driver another, which sessions meet
    before they are fanned out: sessions and driver-seasons are exchanged by driver, the fan-out never is.
    """
    s = with_session_date(results)
    m = round_window_map(results, year_start, year_stop, n).groupBy("year", "roundnumber").agg(
        F.collect_list(F.struct("dt_ref", "rn", "yk")).alias("_dates"))
    bound = date_bound(year_start, year_stop)    # the arrays hold as many dates as the map has rows
    fan = s.join(by_exchange(known_dates(results, year_start, year_stop, year_lag)), "driverid")
    fan = fan.join(maybe_broadcast(m, None if bound is None else bound * n), ["year", "roundnumber"])
    seen = F.filter("_dates", lambda t: (F.col("d") <= t["dt_ref"]) & F.array_contains("_known", t["dt_ref"]))
    out = fan.withColumn("_t", F.explode(seen))
    return out.select(F.col("_t.dt_ref").alias("dt_ref"), *s.columns, F.col("_t.rn").alias("rn"), F.col("_t.yk").alias("yk"))
