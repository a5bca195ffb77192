"""Fill-in-middle transformation (operator 12) as a pyarrow.compute pipeline.

A text of ``n`` code points is cut twice; its three pieces are put in the order
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), each after its
marker, or the text stays as it is (``plain``). Where it is cut and which form it
takes follow from the sha256 of a seed and its id, so a rerun gives the same rows.

Per Arrow batch: texts are split into list arrays of units (code points; the list
array shares the text's bytes), flattened with their parent indices, given
ordinals, filtered by role (before the first cut, between the cuts, after them),
put back into lists and joined to pieces by ``binary_join``; pieces and markers are
joined per element. Units take several times their bytes, so the pipeline runs on
slices of at most ``SLICE_BYTES`` of text; a longer text is split at code points
into rows of its own, whose pieces are joined again. Memory is that of the batch.

Defined results: null text is empty; an empty text, or one that holds a marker, is
plain; a null id is hashed as the empty string; repeated rows stay repeated; no
rows give no rows. Other columns are carried where the caller names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 2 << 20
NOTHING = pa.scalar("", pa.large_string())


def hashes(id_col: str, seed: int, n: int = 4) -> list[Column]:
    """The first ``n`` 8-digit groups, as numbers, of the hex sha256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10,
         spm_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (by default the id), ``text`` (null: empty), ``n``, ``form``, ``prefix_chars``
    and ``middle_chars`` (null if plain)."""
    keep = [id_col] if keep is None else keep
    h1, h2, h3, h4 = (F.col(f"_h{i}") for i in range(1, 5))
    h = dict(zip(("_h1", "_h2", "_h3", "_h4"), hashes(id_col, seed)))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(m))
    form = (F.when((F.col("n") == 0) | marked | (h3 % 100 >= 100 - plain_percent), "plain")
            .when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    cut = F.col("form") != "plain"
    return (docs.select(*[c for c in keep if c != "text"], F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        *[e.alias(c) for c, e in h.items()])
            .withColumn("n", F.length("text").cast("long")).withColumn("form", form)
            .withColumns({"prefix_chars": F.when(cut, F.least(a, b)),
                          "middle_chars": F.when(cut, F.greatest(a, b) - F.least(a, b))})
            .drop("_h1", "_h2", "_h3", "_h4"))


# ------------------------------------------------------------ Arrow pipeline

def split_units(texts: pa.LargeStringArray) -> pa.LargeListArray:
    """Each text as the list of its code points; the units share the texts' bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.empty(0, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)     # not a continuation byte
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
                                             pa.py_buffer(data))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, offsets - offsets[0])), units)


def cut_pieces(texts: pa.LargeStringArray, first: pa.Array, cut1: pa.Array, cut2: pa.Array) -> dict[str, pa.Array]:
    """Prefix, middle and suffix of each row: units are numbered from ``first`` on, those before
    ``cut1`` are prefix, those before ``cut2`` middle, the rest suffix."""
    lists = split_units(texts)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    at = pc.subtract(pa.array(np.arange(len(units))), pc.take(lists.offsets, parent))
    ordinal = pc.add(at, pc.take(first, parent))
    before1, before2 = pc.less(ordinal, pc.take(cut1, parent)), pc.less(ordinal, pc.take(cut2, parent))
    roles = {"prefix": before1, "middle": pc.and_not(before2, before1), "suffix": pc.invert(before2)}
    pieces = {}
    for role, mask in roles.items():
        counts = np.bincount(pc.filter(parent, mask).to_numpy(), minlength=len(texts))
        rebuilt = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts))), pc.filter(units, mask))
        pieces[role] = pc.binary_join(rebuilt, NOTHING)
    return pieces


def _chunks(texts: pa.LargeStringArray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end byte) of pieces of at most ``most`` bytes that end between code points."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    rows, starts, ends = [], [], []
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while b - a > most:
            end = a + most
            while (data[end] & 0xC0) == 0x80:
                end -= 1
            rows.append(row), starts.append(a), ends.append(end)
            a = end
        rows.append(row), starts.append(a), ends.append(b)
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def rearrange(texts: pa.Array, form: pa.Array, prefix: pa.Array, middle: pa.Array,
              slice_bytes: int = SLICE_BYTES) -> pa.Array:
    """The texts in the form that is given for each."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return texts
    rows, starts, ends = _chunks(texts, slice_bytes)
    data = texts.buffers()[2]
    bytes_of = np.frombuffer(data or b"", np.uint8)
    cut1 = pc.fill_null(prefix, 0).to_numpy().astype(np.int64)
    cut2 = cut1 + pc.fill_null(middle, 0).to_numpy().astype(np.int64)
    found: dict[str, list] = {"prefix": [], "middle": [], "suffix": []}
    done, last_row = 0, -1
    group = np.cumsum(ends - starts) // max(1, slice_bytes)
    for at in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(group)) + 1):
        # rows are consecutive in the buffer, so a run of chunks is one string array
        bounds = np.append(starts[at], ends[at[-1]])
        piece = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), data or pa.py_buffer(b""))
        lengths = np.diff(np.searchsorted(np.flatnonzero((bytes_of[bounds[0]:bounds[-1]] & 0xC0) != 0x80),
                                          bounds - bounds[0]))
        r = rows[at]
        # units of the same row before each chunk, in this slice and in the ones before
        before = np.cumsum(lengths) - lengths
        first = before - before[np.searchsorted(r, r)] + np.where(r == last_row, done, 0)
        done, last_row = int(first[-1] + lengths[-1]), r[-1]
        for role, got in cut_pieces(piece, pa.array(first), pa.array(cut1[r]), pa.array(cut2[r])).items():
            found[role].append(got)
    whole = {}
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    for role, got in found.items():
        joined = pa.concat_arrays(got)
        whole[role] = joined if len(joined) == len(texts) else pc.binary_join(
            pa.LargeListArray.from_arrays(pa.array(bounds), joined), NOTHING)
    join = lambda *x: pc.binary_join_element_wise(*[pa.scalar(v, pa.large_string()) if isinstance(v, str) else v
                                                    for v in x], NOTHING)
    psm = join(PREFIX, whole["prefix"], SUFFIX, whole["suffix"], MIDDLE, whole["middle"])
    spm = join(SUFFIX, whole["suffix"], PREFIX, whole["prefix"], MIDDLE, whole["middle"])
    return pc.if_else(pc.equal(form, "plain"), texts, pc.if_else(pc.equal(form, "psm"), psm, spm))


# --------------------------------------------------------------------- Spark

def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10,
              spm_percent: int = 20, keep: list[str] | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` (by default the id), n, form, prefix_chars, middle_chars, output."""
    small_batches(docs.sparkSession)
    planned = plan(docs, id_col, text_col, seed, plain_percent, spm_percent, keep)
    carried = [c for c in planned.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = rearrange(batch.column("text"), batch.column("form"), batch.column("prefix_chars"),
                            batch.column("middle_chars"), slice_bytes)
            kept = [batch.column(c) for c in carried]
            # outputs of over 2 GB in one batch do not fit a string array
            half = batch.num_rows // 2 if out.nbytes > 1 << 30 else 0
            for a, b in ((0, half), (half, batch.num_rows)):
                if b > a:
                    yield pa.record_batch([*(c.slice(a, b - a) for c in kept), out.slice(a, b - a).cast(pa.string())],
                                          [*carried, "output"])

    fields = [f"`{c}` {planned.schema[c].dataType.simpleString()}" for c in carried]
    return planned.mapInArrow(run, ", ".join([*fields, "output string"]))


def restore(output: Column, form: Column) -> Column:
    """The exact text of an output: no piece holds a marker, so the markers split it."""
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def digests(formed: DataFrame) -> DataFrame:
    """Lengths, and digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                         sha(F.col("output")).alias("output_sha256"),
                         sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
