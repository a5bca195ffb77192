"""Seasons of the grid, payload records, upsert into odd partitions, the entry without its optional part."""

import datetime as dt
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import types as T

from conftest import ROOT, rows
from asofstore.operators import ingest, report
from asofstore.sources.upsert import upsert


def test_grid_follows_what_has_landed(spark):
    day = dt.datetime(1998, 1, 1)
    df = rows(spark, [("d", y, 1, "Race", day, 1.0, 1.0, 1.0, "", "", "", "") for y in (1996, 1999)])
    assert {r.year for r in ingest.session_grid(df, 2, ahead=1).collect()} == {1996, 1997, 1998, 1999, 2000}
    assert {r.year for r in ingest.session_grid(df, 2).collect()} == {1996, 1999}
    assert ingest.session_grid(df.where("false"), 2, ahead=1).collect() == []
    assert "Scan" in ingest.session_grid(df, 2, ahead=1)._jdf.queryExecution().executedPlan().toString()


SHAPE = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType())])


@pytest.mark.parametrize("text,want", [
    ('{"values": [{"id": "a", "x": 1.5, "n": 3}]}', [(None, ("a", 1.5, 3))]),
    ('{"values": [{"id": "a"}, {"x": null, "n": "4"}], "more": 1}', [(None, ("a", None, None)), (None, (None, None, 4))]),
    ('{"values": [{"id": "a", "x": "no"}, {"id": "b", "x": 2}]}', [("x is no double", None), (None, ("b", 2.0, None))]),
    ('{"values": [{"n": 1.5}]}', [("n is no bigint", None)]),
    ('{bad', [("not a JSON object", None)]), ("", [("not a JSON object", None)]), (None, [("not a JSON object", None)]),
    ('{"rows": []}', [("no values", None)]), ('{"values": null}', [("no values", None)]), ('{"values": 5}', [("no values", None)]),
    ('{"values": []}', [("No features provided", None)]), ('{"values": [null]}', [("a record is no object", None)]),
])
def test_each_bad_form_has_a_reason(spark, text, want):
    got = report.checked_records(spark.createDataFrame([("q", text)], "request string, payload string"), SHAPE).collect()
    assert [(r.reason, None if r.record is None else tuple(r.record)) for r in got] == want
    assert all(r.request == "q" for r in got)


def test_responses_are_cut_by_ids(spark):
    df = spark.range(250).selectExpr("'d' AS day", "concat('k', id) AS id", "id / 250D AS p")
    texts = report.responses(df, "day", "id", "p", per=20).collect()
    assert len(texts) > 5 and max(r.payload.count('"0":') for r in texts) < 60
    assert sum(r.payload.count('"0":') for r in texts) == 250
    with pytest.raises(Exception, match="(?i)duplicate"):
        report.responses(df.union(df), "day", "id", "p", per=20).collect()


@pytest.mark.parametrize("kind,first,second", [
    ("string", "a/b", "z"), ("string", "x:y=%{1}", "q"), ("string", "é ü", "a\\b"), ("string", None, "n"),
    ("timestamp", dt.datetime(2020, 1, 1, 10, 30), dt.datetime(2021, 1, 1)), ("date", dt.date(2020, 1, 1), dt.date(2021, 2, 3)),
    ("double", 1.5, -0.25), ("decimal(5,2)", None, None)])
def test_no_row_stays_in_an_emptied_partition(spark, kind, first, second):
    if kind.startswith("decimal"):
        from decimal import Decimal
        first, second = Decimal("1.50"), Decimal("2.25")
    path = tempfile.mkdtemp(prefix="asof-upsert-", dir="/tmp") + "/t"
    schema = f"k string, v int, p {kind}"
    upsert(spark, path, spark.createDataFrame([("a", 1, first), ("b", 1, first), ("c", 1, second)], schema), ["k"], "p")
    upsert(spark, path, spark.createDataFrame([("a", 2, second), ("b", 2, second)], schema), ["k"], "p")
    got = sorted((r.k, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [("a", 2, second), ("b", 2, second), ("c", 1, second)]
    assert len([f for f in os.listdir(path) if f.startswith("p=")]) == 1


@pytest.mark.parametrize("missing", ["public_tokenizers", "xxhash", "asofstore.llm", "corpus_pipeline"])
def test_store_queries_do_not_need_the_optional_part(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\nimport __spark_entry__ as E\n"
            "print(len(E.catalog.QUERIES), len(E.queries()), len(E.oracle_sql()) >= len(E.catalog.ORACLE))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    store, found, oracles = out.stdout.split()
    assert oracles == "True" and int(found) >= int(store)


def test_csv_lines_that_do_not_fit_come_out_as_they_are(spark):
    from asofstore.sources import files
    path = tempfile.mkdtemp(prefix="asof-csv-", dir="/tmp")
    lines = ["a;1;2.5", "b;x;2.5", "c;1", "d;1;2.5;9", "\\N;\\N;\\N", "e;;1"]
    with open(path + "/part.csv", "w") as out:
        out.write("\n".join(["id;n;x", *lines]) + "\n")
    kind = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())])
    rows_ = files.read_csv_checked(spark, path, kind).cache().collect()
    good = [tuple(r)[:3] for r in rows_ if r.reject_line is None]
    assert good == [("a", 1, 2.5), (None, None, None), ("e", None, 1.0)]
    assert [r.reject_line for r in rows_ if r.reject_line] == [lines[1], lines[2], lines[3]]
