"""Operator 13: archives as any WARC reader sees them, the index against brute force."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from asofstore.llm import warc
from asofstore.session import scratch_dir

KIND = "page_id bigint, url string, html string, key string, file string, digest string, refers_to int, _class int"
PAGES = [
    (1, "https://www.Example.com/a?b=1", "<p>one</p>"), (2, "http://example.com/a", "<p>two</p>"),
    (3, "https://www.example.com/a?b=1", "<p>one</p>"), (4, None, None), (5, "http://x.org", ""),
    (6, "not a url\r\nwith lines", "é漢😀\r\n\r\nWARC/1.1\r\n\r\n"), (7, "", "<p>two</p>"),
    (None, "http://example.com/a", "<p>two</p>"), (8, "http://u:p@h.example.com:8080/x", "x" * 300_000),
    (9, "http://rep.org/", "again"), (9, "http://rep.org/", "again"), (10, "http://x.org", None),
    (11, "http://x.org/" + "long" * 200, "tail"),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*p, "k", "f", "d", 1, 2) for p in PAGES], KIND).repartition(3)


def expected(pages, least_bytes=0):
    owner = {}
    for i, _, x in pages:
        x = (x or "").encode()
        if len(x) >= least_bytes:
            owner[x] = max(owner.get(x, -1), -1 if i is None else i)
    out = []
    for i, _, x in pages:
        x = (x or "").encode()
        top = owner.get(x, -1)
        other = top if top >= 0 and top != i else None
        digest = base64.b32encode(hashlib.sha1(x).digest()).decode()
        out.append((str(i), len(x), digest, "response" if other is None else "revisit", str(other)))
    return sorted(out)


def got(df):
    return sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]))
                  for r in df.collect())


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(pages, least):
    assert got(warc.round_trip(pages, least)) == expected(PAGES, least)


def test_salted_join_gives_the_same(pages, monkeypatch):
    plain = warc.keyed_join
    monkeypatch.setattr(warc, "keyed_join", lambda *a: plain(*a, most=0, salts=3))
    assert got(warc.round_trip(pages)) == expected(PAGES)


def test_keys(spark):
    urls = [("https://www.Example.com:8080/A?b#c", "com,example,www:8080)/A?b#c"), ("http://u:p@h.org", "org,h)"),
            ("//a.b/c", "b,a)/c"), (None, ""), ("", ")"), ("a.b/c\nd", "b,a)/c\nd")]
    df = spark.createDataFrame(urls, "url string, want string")
    assert all(r["key"] == r["want"] for r in df.withColumn("key", warc.reversed_host_key(F.col("url"))).collect())


def path_of(folder):
    return folder.removeprefix("file:")


def test_archives_are_plain_record_sequences(spark, pages):
    folder = scratch_dir(spark, "test-warc")
    captures = warc.write_archives(pages, folder, archive_bytes=500)
    files = {r["file"] for r in captures.collect()}
    assert len(files) > 3 and set(os.listdir(path_of(folder))) == files      # files are closed at 500 bytes
    payloads = []
    for f in files:
        rest = gzip.open(f"{path_of(folder)}/{f}").read()
        while rest:
            head, _, _ = rest.partition(b"\r\n\r\n")
            length = int(head.rsplit(b"Content-Length: ", 1)[1])
            end = len(head) + 4 + length + 4
            payloads.append(warc.parse_record(rest[:end])["payload"])
            rest = rest[end:]
    assert len(payloads) == len(PAGES)
    assert {p for p in payloads if p is not None} == {(x or "").encode() for _, _, x in PAGES}


def test_records_are_checked(spark):
    data = warc.record(1, "http://a.b", b"text", "WRONG", None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="differs from its digest"):
        warc.parse_record(data)
    with pytest.raises(ValueError, match="no whole WARC record"):
        warc.parse_record(data[:-2])


@pytest.mark.parametrize("segments,block", [(1, 3000), (7, 5), (40, 2)])
def test_find_equals_a_scan(spark, monkeypatch, segments, block):
    """A URL with a third of all captures, keys that share a long prefix, and absent keys."""
    keys = ["com,hot)/"] * 60 + [f"com,a{i % 17})/{i}" for i in range(60)] + ["org," + "p" * 300 + f")/{i % 9}" for i in range(60)]
    rows = [(k, i, f"f{i % 4}", i, 10 + i) for i, k in enumerate(keys)]
    captures = spark.createDataFrame(rows, "key string, page_id bigint, file string, offset bigint, length bigint") \
        .withColumn("key", F.col("key").cast("binary"))
    monkeypatch.setattr(warc, "segment_count", lambda n: segments)
    index = warc.build_index(captures, scratch_dir(spark, "test-index"), block=block)
    assert sum(s[4] for s in index.segments) == len(rows)
    wanted = ["com,hot)/", "com,a3)/20", "org," + "p" * 300 + ")/4", "com,a", "zzz", "", "com,hot)/"]
    asked = spark.createDataFrame([(k,) for k in wanted], "key string").select(F.col("key").cast("binary").alias("key"))
    found = sorted((bytes(r["key"]).decode(), r["page_id"], r["file"], r["offset"], r["length"])
                   for r in warc.find(index, asked).collect())
    assert found == sorted(r for r in rows if r[0] in wanted)


def test_payloads_by_url(spark, pages):
    folder = scratch_dir(spark, "test-lookup")
    captures = warc.write_archives(pages, f"{folder}/archives")
    index = warc.build_index(captures, f"{folder}/index")
    asked = spark.createDataFrame([("http://EXAMPLE.com/a",)], "url string").select(
        warc.reversed_host_key(F.col("url")).cast("binary").alias("key"))
    records = warc.read_records(warc.find(index, asked), f"{folder}/archives").collect()
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in records) == [
        ("2", "revisit", "7"), ("None", "revisit", "7")]


def test_no_pages(pages):
    assert got(warc.round_trip(pages.where("false"))) == []
