"""WARC archives with a two-level capture index (operator 13).

Archives: each task writes the pages of its partition to ``.warc.gz`` files of its
own (one gzip member per record, so a record is read by its range) and returns a
capture row per record. Captures are committed by Spark as a table; a file of a
task that failed is in no capture and so is never read.

Of pages with equal payloads the one with the largest page_id is a ``response`` with
the payload, the others are ``revisit`` records that refer to it and have none.
Payloads shorter than ``least_bytes`` are always responses.

Index: captures are range-partitioned and sorted by reversed-host URL key
(``com,example,www)/path``). Each partition is a segment file: blocks of at most
``BLOCK_CAPTURES`` captures, compressed one by one, and at its end the sparse block
directory (first and last key, offset and length of each block). The table of
segments has a row per file. A lookup binary-searches the segments' bounds, then a
segment's directory, then one block, and reads only these ranges; the captures it
finds are read from the archives by range, in file order.

On Spark: page texts are exchanged at most once (only if the payloads with copies
are too many to broadcast); all other exchanges carry captures and keys. A host or
URL that holds a third of all captures is many segments, as ties are cut by
page_id and place. Tasks reach the folder through ``pyarrow.fs``, so it must be a
mounted path or a store that pyarrow knows (file, hdfs, s3, gs).

Defined results: null html is an empty payload; a null URL is the empty key; a null
page_id is smaller than any; rows that share the largest page_id of their payload
are all responses; no rows give no archive. Control characters and spaces in a URL
are percent-encoded in the record. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import keyed_join, small_batches, stage, unstage

ARCHIVE_BYTES = 256 << 20
BLOCK_CAPTURES = 3000
READ_BYTES = 64 << 20
BOUND_BYTES = 256
RECORD_ID = "urn:page:"
# WARC 1.1 names.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key binary, page_id long, file string, offset long, length long"
RECORDS = ("page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "url string, payload binary")


# --------------------------------------------------------------- small helpers

def reversed_host_key(url: Column) -> Column:
    """``https://www.Example.com:8080/a?b`` as ``com,example,www:8080)/a?b``; null is empty."""
    form = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]+)?(.*)$"
    host, port, rest = (F.regexp_extract(url, form, i) for i in (1, 2, 3))
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), port, F.lit(")"), rest)
    return F.coalesce(key, F.lit(""))


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, 10 hex digits (8 characters) at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.lower(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if re.match(r"^[a-z0-9]+:/", folder):
        return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
    return pa.fs.LocalFileSystem(), folder


def _write_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


# -------------------------------------------------------------------- records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda i: f"<{RECORD_ID}{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one uncompressed record, checked: lengths, end, and a response's digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    if first != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("no whole WARC record")
    number = lambda name: int(t) if (t := fields[name][1 + len(RECORD_ID):-1]) else None
    out = {"page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": None,
           "payload_bytes": None, "payload_digest": None, "url": fields.get("WARC-Target-URI"), "payload": None}
    if out["record_type"] == "revisit":
        return out | {"refers_to": number("WARC-Refers-To"), "payload_digest": fields["WARC-Payload-Digest"][5:]}
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if fields["WARC-Payload-Digest"] != f"sha1:{digest}" or int(http.rsplit(b" ", 1)[1]) != len(payload):
        raise ValueError(f"payload of record {fields['WARC-Record-ID']} differs from its digest or length")
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload}


# -------------------------------------------------------------------- archives

def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page to archives in ``folder``; returns the captures (staged)."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("_class", F.sha2("payload", 256))
    copies = stage(rows.where(F.length("payload") >= least_bytes).groupBy("_class")
                   .agg(F.max("page_id").alias("owner"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "warc-copies")
    joined = keyed_join(rows, copies, "_class", ["page_id", "url"])
    refers = F.when(~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))
    todo = joined.select("page_id", "url", reversed_host_key(F.col("url")).cast("binary").alias("key"), "payload",
                         base32_sha1(F.col("payload")).alias("digest"), refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        out, name = None, ""
        try:
            for batch in batches:
                places = []
                for r in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    if out is not None and out.tell() >= archive_bytes:
                        out.close()
                        out = None
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip.compress(record(*(v.as_py() for v in r), date), 6, mtime=0)
                    places.append((name, out.tell(), len(member)))
                    out.write(member)
                if places:
                    file, offset, length = zip(*places)
                    yield pa.record_batch([batch.column("key"), batch.column("page_id"), pa.array(file), pa.array(offset, pa.int64()),
                                           pa.array(length, pa.int64())], ["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    fs, path = _store(folder)
    fs.create_dir(path, recursive=True)
    captures = stage(todo.mapInArrow(write, CAPTURES), "warc-captures")
    unstage(copies)
    return captures


# ----------------------------------------------------------------------- index

@dataclass
class Index:
    """Segment files in ``folder``; ``segments``: (file, first_key, last_key, directory_at, n) of each."""

    spark: SparkSession
    folder: str
    segments: list[tuple[str, bytes, bytes, int, int]]


def segment_count(captures: int) -> int:
    """Segments of 4,096 captures or more, up to 1,024 of them; beyond that of up to 4,000,000 each."""
    per = min(max(captures // 1024, 4096), 4_000_000)
    return max(1, -(-captures // per))


def build_index(captures: DataFrame, folder: str, block: int = BLOCK_CAPTURES) -> Index:
    """Sort captures by key into segment files. The driver gets a row per segment, with keys cut
    to ``BOUND_BYTES`` (a search by cut bounds reads a segment too many, never too few)."""
    order = ["key", "page_id", "file", "offset"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        name = f"{uuid.uuid4().hex}.cdx"
        out, rest, directory, total = None, [], [], 0

        def put(rows: pa.Table) -> None:
            data = _write_ipc(rows.combine_chunks().to_batches()[0])
            keys = rows.column("key")
            directory.append((keys[0].as_py(), keys[-1].as_py(), out.tell(), len(data)))
            out.write(data)

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or fs.open_output_stream(f"{path}/{name}", compression=None)
                total += batch.num_rows
                rest = pa.concat_tables([*rest, pa.Table.from_batches([batch])])
                while rest.num_rows >= block:
                    put(rest.slice(0, block))
                    rest = rest.slice(block)
                rest = [rest]
            if out is not None:
                if rest[0].num_rows:
                    put(rest[0])
                at, sparse = out.tell(), zip(*directory)
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
                out.write(_write_ipc(pa.record_batch([pa.array(c, k) for c, k in zip(sparse, kinds)],
                                                     ["first_key", "last_key", "offset", "length"])))
                yield pa.record_batch([[name], pa.array([directory[0][0][:BOUND_BYTES]], pa.binary()),
                                       pa.array([directory[-1][1][:BOUND_BYTES]], pa.binary()), pa.array([at], pa.int64()),
                                       pa.array([total], pa.int64())], ["file", "first_key", "last_key", "directory_at", "n"])
        finally:
            if out is not None:
                out.close()

    fs, path = _store(folder)
    fs.create_dir(path, recursive=True)
    spread = captures.select(*order, "length").repartitionByRange(segment_count(captures.count()), *order)
    table = stage(spread.sortWithinPartitions(*order).mapInArrow(
        write, "file string, first_key binary, last_key binary, directory_at long, n long"), "warc-segments")
    found = sorted((bytes(r["first_key"]), bytes(r["last_key"]), r["file"], r["directory_at"], r["n"]) for r in table.collect())
    unstage(table)
    return Index(captures.sparkSession, folder, [(f, a, b, at, n) for a, b, f, at, n in found])


class _Segment:
    """One open segment: its directory, and the block read last."""

    def __init__(self, fs: pa.fs.FileSystem, path: str, directory_at: int):
        self.file = fs.open_input_file(path)
        d = _read_ipc(self.file.read_at(self.file.size() - directory_at, directory_at))
        self.first, self.last, self.offset, self.length = (d.column(c).to_pylist() for c in d.column_names)
        self.at, self.block, self.keys = -1, None, []

    def captures(self, key: bytes) -> Iterator[pa.Table]:
        """Binary search for the first block that can hold ``key``, then inside each that does."""
        b = bisect_left(self.last, key)
        while b < len(self.first) and self.first[b] <= key:
            if b != self.at:
                self.at, self.block = b, _read_ipc(self.file.read_at(self.length[b], self.offset[b]))
                self.keys = self.block.column("key").to_pylist()
            low, high = bisect_left(self.keys, key), bisect_right(self.keys, key)
            if high > low:
                yield self.block.slice(low, high - low)
            b += 1


def find(index: Index, keys: DataFrame) -> DataFrame:
    """The captures of every distinct ``key`` (binary) of ``keys``."""
    firsts, lasts = [s[1] for s in index.segments], [s[2] for s in index.segments]
    files = {i: (s[0], s[3]) for i, s in enumerate(index.segments)}
    folder = index.folder

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for key in batch.column("key").to_pylist():
                cut = key[:BOUND_BYTES]
                pairs += [(s, key) for s in range(bisect_left(lasts, cut), bisect_right(firsts, cut))]
            if pairs:
                segment, key = zip(*pairs)
                yield pa.record_batch([pa.array(segment, pa.int32()), pa.array(key, pa.binary())], ["segment", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        number, segment, found, rows = -1, None, [], 0
        for batch in batches:
            for s, key in zip(batch.column("segment").to_pylist(), batch.column("key").to_pylist()):
                if s != number:
                    number, segment = s, _Segment(fs, f"{path}/{files[s][0]}", files[s][1])
                for some in segment.captures(key):
                    found.append(some)
                    rows += some.num_rows
                    if rows >= BLOCK_CAPTURES:
                        yield from _in_order(found)
                        found, rows = [], 0
        if found:
            yield from _in_order(found)

    wanted = keys.select(F.col("key")).where("key IS NOT NULL").distinct()
    dealt = wanted.mapInArrow(assign, "segment int, key binary")
    return (dealt.repartition(max(1, len(index.segments)), "segment").sortWithinPartitions("segment", "key")
            .mapInArrow(search, CAPTURES))


def _in_order(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    names = ["key", "page_id", "file", "offset", "length"]
    yield from pa.concat_tables([t.select(names) for t in tables]).combine_chunks().to_batches()


# --------------------------------------------------------------- range reads

def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the captures (staged): ``RECORDS``; a revisit has no payload and no
    length; ``payload`` is null without ``payloads``. Reads are dealt in runs of ``READ_BYTES`` in file order."""
    spark = captures.sparkSession
    total = captures.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    near = captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        name, file, rows, size = None, None, [], 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for f, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if f != name:
                    name, file = f, fs.open_input_file(f"{path}/{f}")
                r = parse_record(gzip.decompress(file.read_at(length, offset)))
                if not payloads:
                    r["payload"] = None
                rows.append(r)
                size += len(r["payload"] or b"") + 200
                if size >= 8 << 20:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return near.sortWithinPartitions("file", "offset").mapInArrow(read, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records (staged) with a revisit's payload length taken from the response that it refers to, which
    must have the revisit's payload digest; without such a response the length stays null."""
    named = records.withColumn("_ref", F.concat_ws(":", F.col("payload_digest"), F.when(
        F.col("record_type") == "revisit", F.col("refers_to")).otherwise(F.col("page_id")).cast("string")))
    wanted = named.where("record_type = 'revisit'").select("_ref").distinct()
    answers = stage(named.where("record_type = 'response'").select("_ref", F.col("payload_bytes").alias("_bytes"))
                    .distinct().join(wanted, "_ref", "left_semi"), "warc-answers")
    both = keyed_join(named, answers, "_ref", ["page_id", "url"])
    return both.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes", "_ref")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write every page, index the archives, look up every URL and read the records back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, url. The archives go afterwards."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "llm-warc")
    captures = write_archives(pages, f"{folder}/archives", least_bytes)
    index = build_index(captures, f"{folder}/index")
    found = stage(find(index, pages.select(reversed_host_key(F.col("url")).cast("binary").alias("key"))), "warc-found")
    records = stage(read_records(found, f"{folder}/archives", payloads=False), "warc-records")
    unstage(captures, found)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
