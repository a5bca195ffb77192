"""The one-pass windows against sums over the rows that each definition names."""

import datetime as dt
import random

import numpy as np
import pytest

from conftest import rows
from asofstore.operators import features as FE
from asofstore.operators import windows as WN


def test_runs_are_joined_from_blocks():
    rng = np.random.default_rng(1)
    values = rng.integers(-9, 9, (37, 2)).astype(float)
    low = rng.integers(0, 38, 200)
    high = np.minimum(low + rng.integers(-2, 20, 200), 37)
    got = WN._over_runs(WN._blocks(values, np.add), low, high, np.add, 0.0)
    least = WN._over_runs(WN._blocks(values[:, 0], np.minimum), low, high, np.minimum, 99.0)
    for a, b, s, m in zip(low, high, got, least):
        assert (s == values[a:max(a, b)].sum(axis=0)).all()
        assert m == (values[a:b, 0].min() if b > a else 99.0)


def random_sessions(seed):
    """Rounds out of date order, several sessions of a round and a day, gaps, nulls, repeated rows."""
    r = random.Random(seed)
    out = []
    for d in ("a", "b", "c", None):
        for _ in range(r.randint(5, 60)):
            year = r.choice([1950, 1997, 1998, 1999, 2000, 2016])
            day = dt.datetime(year, r.randint(1, 12), r.choice([7, 14, 28]))
            out.append((d, r.choice([year, year, year, None]), r.choice([1, 2, 3, 4, 5, 6, 7]), r.choice(["Race", "Sprint", "Other", None]),
                        r.choice([day, day, day, day, None]), r.choice([None, 1.0, 2.0, 7.0]), r.choice([None, 1.0, 4.0, 9.0]),
                        r.choice([None, 0.0, 2.25, 10.5]), r.choice([None, "Finished", "+1 Lap", "Retired"]), "n", "t", "c"))
    return out + out[:5]


def brute(data, ys, ye, windows, lag=2):
    s = [(x[0], x[1], x[2], x[3], x[4].date(), *x[5:9]) for x in data if x[4] is not None]
    out = {}
    for t, ref in sorted({(x[4], x[1]) for x in s if x[1] is not None and ys <= x[1] <= ye}):
        seen = [x for x in s if x[4] <= t]
        rounds = sorted({x[1:3] for x in seen if x[1] is not None and x[2] is not None}, reverse=True)
        for d in {x[0] for x in seen if x[0] is not None and x[1] is not None and x[1] >= ref - lag}:
            row = {}
            for w, n in windows.items():
                keep = set(rounds if n is None else rounds[:n])
                mine = [x for x in seen if x[0] == d and (n is None or x[1:3] in keep)]
                row[w] = features(mine)
            if all(f["qtd_sessions"] for f in row.values()):
                out[t, d] = {f"{c}{w}": v for w, f in row.items() for c, v in f.items()}
    return out


def features(mine):
    out = {"qtd_seasons": len({x[1] for x in mine} - {None}), "qtd_sessions": len(mine),
           "qtd_race": sum(x[3] == "Race" for x in mine), "qtd_sprint": sum(x[3] == "Sprint" for x in mine)}
    yes = {"qtde_sessions_finished": lambda p, g, pt, st: st is not None and (st == "Finished" or st[0] == "+"),
           "qtde_1pos": lambda p, g, pt, st: p == 1, "qtde_podios": lambda p, g, pt, st: p is not None and p <= 3,
           "qtde_pos5": lambda p, g, pt, st: p is not None and p <= 5,
           "qtde_gridpos5": lambda p, g, pt, st: g is not None and g <= 5,
           "qtde_1_gridposition": lambda p, g, pt, st: g == 1, "qtde_pole_win": lambda p, g, pt, st: g == 1 and p == 1,
           "qtd_sessions_with_points": lambda p, g, pt, st: pt is not None and pt > 0,
           "qtde_sessions_with_overtake": lambda p, g, pt, st: p is not None and g is not None and p < g}
    value = {"avg_gridposition": lambda p, g, pt, st: g, "avg_position": lambda p, g, pt, st: p,
             "avg_overtake": lambda p, g, pt, st: None if p is None or g is None else g - p,
             "qtde_points": lambda p, g, pt, st: pt}
    for tail, mode in (("", None), ("_race", "Race"), ("_sprint", "Sprint")):
        part = [x[5:9] for x in mine if mode is None or x[3] == mode]
        for c, f in yes.items():
            out[c + tail] = sum(f(*x) for x in part)
        for c, f in value.items():
            known = [v for v in (f(*x) for x in part) if v is not None]
            out[c + tail] = None if not known else sum(known) if c == "qtde_points" else sum(known) / len(known)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_the_definitions(spark, seed, monkeypatch):
    monkeypatch.setattr(WN, "CHUNK", 30)
    data = random_sessions(seed)
    windows = {"life": None, "two": 2, "nine": 9}
    got = FE.consolidated_features(rows(spark, data), 1950, 2016, windows=windows, dedupe=True, with_id=False)
    want = brute(data, 1950, 2016, {f"_{w}": n for w, n in windows.items()})
    found = {(r["dt_ref"], r["driverid"]): {c: v for c, v in r.asDict().items() if c[:3] in ("qtd", "avg")} for r in got.collect()}
    assert set(found) == set(want)
    for k, row in want.items():
        assert set(found[k]) == set(row)
        for c, v in row.items():
            assert found[k][c] == (v if v is None else pytest.approx(v)), (k, c)


def test_one_exchange_by_driver_and_none_of_a_fan_out(spark, results):
    plan = FE.window_features(results, 1995, 2001, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(driverid") >= 1 and "REPARTITION_BY_COL" in plan
    after = plan[:plan.index("REPARTITION_BY_COL")]
    assert "HashAggregate" not in after.split("MapInArrow")[0]      # nothing is aggregated after the pass


def test_no_sessions(spark):
    assert FE.consolidated_features(rows(spark, []), 1995, 2001).collect() == []
