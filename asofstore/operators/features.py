"""The 43 point-in-time driver features and the windowed feature stores.

Feature families (each family has an all-sessions, a race and a sprint
variant unless noted):

===============================  =====================================================
qtd_seasons (1)                  distinct seasons
qtd_sessions (1)                 sessions
qtd_race, qtd_sprint (2)         sessions of that type
qtde_sessions_finished           status 'Finished' or starting with '+'
qtde_1pos                        position = 1
qtde_podios                      position <= 3
qtde_pos5                        position <= 5
qtde_gridpos5                    gridposition <= 5 (no lower bound)
qtde_points                      sum of points (NULL when no value)
avg_gridposition                 mean grid position (NULLs ignored)
avg_position                     mean finishing position
qtde_1_gridposition              gridposition = 1
qtde_pole_win                    gridposition = 1 and position = 1
qtd_sessions_with_points         points > 0
qtde_sessions_with_overtake      position < gridposition
avg_overtake                     mean of gridposition - position
===============================  =====================================================

All windows come from one pass over sessions dealt by driver (:mod:`.windows`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ATTRIBUTES, KEYS, MODE_SUFFIX, RACE, SPRINT, WINDOWS
from . import asof
from . import windows as WN


# Feature families in output order, as SQL over one session
# row (a predicate for counts, a value for sums and means). Every family has
# an all-sessions, a race and a sprint variant.
FAMILIES = [
    ("qtde_sessions_finished", "count", "status = 'Finished' OR startswith(status, '+')"),
    ("qtde_1pos", "count", "position = 1"),
    ("qtde_podios", "count", "position <= 3"),
    ("qtde_pos5", "count", "position <= 5"),
    ("qtde_gridpos5", "count", "gridposition <= 5"),
    ("qtde_points", "sum", "points"),
    ("avg_gridposition", "avg", "gridposition"),
    ("avg_position", "avg", "position"),
    ("qtde_1_gridposition", "count", "gridposition = 1"),
    ("qtde_pole_win", "count", "gridposition = 1 AND position = 1"),
    ("qtd_sessions_with_points", "count", "points > 0"),
    ("qtde_sessions_with_overtake", "count", "position < gridposition"),
    ("avg_overtake", "avg", "gridposition - position"),
]


def feature_specs():
    """``[(name, kind, sql, mode)]`` for the 43 features in output order."""
    specs = [("qtd_seasons", "distinct", None, None),
             ("qtd_sessions", "count", "TRUE", None),
             ("qtd_race", "count", "TRUE", RACE),
             ("qtd_sprint", "count", "TRUE", SPRINT)]
    for name, kind, sql in FAMILIES:
        for m in (None, RACE, SPRINT):
            specs.append((name + MODE_SUFFIX[m], kind, sql, m))
    return specs


FEATURE_NAMES = [s[0] for s in feature_specs()]
assert len(FEATURE_NAMES) == 43


def window_feature_names(window: str) -> list[str]:
    return [f"{n}_{window}" for n in FEATURE_NAMES]


def all_feature_names(windows=tuple(WINDOWS)) -> list[str]:
    """The 172 model features: 43 per window, suffixed with the window name."""
    return [c for w in windows for c in window_feature_names(w)]


# ------------------------------------------------------------ additive state

_TYPES = (RACE, SPRINT)


def _state() -> list[tuple[str, str]]:
    """Additive state of one session row, whatever its type: ``[(name, sql)]``."""
    out = [("n", "1L")]
    for name, kind, sql in FAMILIES:
        if kind == "count":
            out.append((name, f"CASE WHEN {sql} THEN 1L ELSE 0L END"))
        else:
            out.append((f"{name}__s", f"CAST({sql} AS DOUBLE)"))
            out.append((f"{name}__n", f"CASE WHEN ({sql}) IS NOT NULL THEN 1L ELSE 0L END"))
    return out


def _feature_plan() -> list[tuple[str, str, str, int]]:
    """(name, kind, state, 0 all 1 race 2 sprint) of the 43 features, in output order."""
    at = {m: i for i, m in enumerate((None, *_TYPES))}
    return [(name, "seasons" if kind == "distinct" else kind,
             "n" if sql in (None, "TRUE") else name.removesuffix(MODE_SUFFIX[mode]) if mode else name, at[mode])
            for name, kind, sql, mode in feature_specs()]


def store_windows(results: DataFrame, year_start: int | None, year_stop: int | None, windows: dict,
                  eligible: DataFrame, wanted: set[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """Features of the windows ``{suffix: rounds, None for the career}`` of the eligible (dt_ref, driverid), which keep ``carry``."""
    s = asof.with_session_date(results).withColumn("mode", F.expr(
        "CASE " + " ".join(f"WHEN mode = '{m}' THEN {i}" for i, m in enumerate(_TYPES)) + f" ELSE {len(_TYPES)} END"))
    finite = any(n is not None for n in windows.values())
    bounds = WN.window_bounds(results, year_start, year_stop, windows) if finite else None
    return WN.driver_windows(s, bounds, eligible, windows, _state(), _feature_plan(), wanted, carry=carry)


# ------------------------------------------------------------------ public API

def window_features(results: DataFrame, year_start: int | None = None,
                    year_stop: int | None = None, last_rounds: int | None = 10,
                    year_lag: int = 2, order: bool = False, probes: DataFrame | None = None,
                    dates: DataFrame | None = None) -> DataFrame:
    """``(dt_ref, driverid, 43 features)`` over the last ``last_rounds`` rounds.

    ``last_rounds=None`` means the whole career. ``order=True`` adds the final
    ``dt_ref DESC, driverid`` sort (a range shuffle); stores do not need it.
    ``probes`` limits the rows to given (dt_ref, driverid) pairs, ``dates`` to given reference dates, for repairs.
    """
    elig = asof.eligible_drivers(results, year_start, year_stop, year_lag)
    if probes is not None:
        elig = elig.join(asof.by_exchange(probes), KEYS, "left_semi")
    if dates is not None:
        elig = elig.join(asof.maybe_broadcast(dates, asof.date_bound(year_start, year_stop)), "dt_ref", "left_semi")
    out = store_windows(results, year_start, year_stop, {"": last_rounds}, elig).select(*KEYS, *FEATURE_NAMES)
    if order:
        out = out.orderBy(F.col("dt_ref").desc(), F.col("driverid"))
    return out


def _attributes(results: DataFrame, dedupe: bool) -> DataFrame:
    """Descriptive attributes per (driverid, date) for the consolidated store.

    The literal left join on (driverid, date) repeats a feature row once per
    session of that day. The session side is first reduced to distinct
    attribute tuples with their multiplicity (map-side combined, so a hot
    driver cannot pile raw rows onto one reducer); the repetition is restored
    after the join. ``dedupe=True`` keeps one tuple per (driverid, date): the
    race's, else the first by session type.
    """
    s = asof.with_session_date(results)
    if dedupe:
        pick = F.min(F.struct((F.col("mode") != RACE).alias("o"), "mode", *ATTRIBUTES))
        return (s.groupBy("driverid", F.col("d").alias("dt_ref")).agg(pick.alias("a"))
                .select("dt_ref", "driverid", *[F.col(f"a.{c}").alias(c) for c in ATTRIBUTES],
                        F.lit(1).alias("mult")))
    return (s.groupBy(F.col("d").alias("dt_ref"), "driverid", *ATTRIBUTES)
            .agg(F.count(F.lit(1)).alias("mult")))


def consolidated_features(results: DataFrame, year_start: int | None = None,
                          year_stop: int | None = None, windows: dict | None = None,
                          year_lag: int = 2, dedupe: bool = False,
                          with_id: bool = True, features: list[str] | None = None,
                          probes: DataFrame | None = None, attributes: bool = True) -> DataFrame:
    """The consolidated store: ``id, dt_ref, driverid``, 4 x 43 features, attributes.

    One pass makes all windows; a row needs a session in each of them. ``features`` limits
    the feature columns (their order is kept), for queries that read a few; ``probes``
    limits the rows to given (dt_ref, driverid) pairs, for repairs. Without ``attributes`` the
    rows are the same and have no attribute columns: a day's sessions are counted, not joined.
    """
    windows = {f"_{w}": n for w, n in (WINDOWS if windows is None else windows).items()}
    names = ATTRIBUTES if attributes else []
    elig = asof.eligible_drivers(results, year_start, year_stop, year_lag, with_mult=not (attributes or dedupe))
    if probes is not None:
        elig = elig.join(asof.by_exchange(probes), KEYS, "left_semi")
    # the attributes join the narrow side, before the pass: features are not exchanged
    if attributes:
        elig = elig.join(asof.by_exchange(_attributes(results, dedupe)), KEYS, "left")
    out = store_windows(results, year_start, year_stop, windows, elig, None if features is None else set(features),
                        [c for c in elig.columns if c not in KEYS])
    if not dedupe:
        # restore one row per session of the day (NULL attributes: one row)
        reps = F.array_repeat(F.lit(1), F.coalesce("mult", F.lit(1)).cast("int"))
        out = out.withColumn("_rep", F.explode(reps)).drop("_rep")
    feats = [c for c in out.columns if c not in {*KEYS, *names, "mult"}]
    cols = [*KEYS, *feats, *names]
    if with_id:
        cols = [feature_id().alias("id")] + cols
    return out.select(*cols)


def features_of(results: DataFrame, rows: DataFrame, year_start: int | None = None, year_stop: int | None = None,
                windows: dict | None = None, features: list[str] | None = None) -> DataFrame:
    """``rows`` (dt_ref, driverid and any other columns) with the features of every window, in one pass.

    The rows go into the pass and come out of it with their features, so a choice of rows (a sample, a split) is
    made on narrow rows and features are made for the chosen ones only. A row without a session in every window
    is dropped, as in the store.
    """
    windows = {f"_{w}": n for w, n in (WINDOWS if windows is None else windows).items()}
    carry = [c for c in rows.columns if c not in KEYS]
    out = store_windows(results, year_start, year_stop, windows, rows, None if features is None else set(features), carry)
    return out.select(*rows.columns, *[c for c in out.columns if c not in rows.columns])


def feature_id() -> Column:
    """``dt_ref || '_' || driverid``."""
    return F.concat_ws("_", F.col("dt_ref").cast("string"), F.col("driverid"))
