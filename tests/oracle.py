"""Compare a Spark DataFrame with a DuckDB query on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    cols = [columns[i].lower() for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return cols, out


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return rows_of(cols, res.fetchall())


def compare(df, con, sql):
    """Return (ok, message)."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark-only={sorted(set(sc) - set(dc))} duck-only={sorted(set(dc) - set(sc))}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
            return False, f"first differing row: {diff[:6]}"
    return True, f"{len(sr)} rows match"
