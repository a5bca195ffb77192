"""Operator 12: pieces by slicing strings, exact round trip, odd rows."""

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from asofstore.llm import fim
from llm_cases import *  # noqa: F401,F403


def expected(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by plain string work."""
    x = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(x) + 1), h[1] % (len(x) + 1)))
    if not x or any(m in x for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(x), "plain", None, None, x
    pre, mid, suf = x[:a], x[a:b], x[b:]
    if h[3] % 100 < 20:
        return len(x), "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return len(x), "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aé漢😀 <>PSM", max_size=40), st.integers(0, 40), st.integers(0, 40),
                          st.sampled_from(["psm", "spm", "plain"])), max_size=6), st.sampled_from([4, 9, 1 << 20]))
def test_pipeline_equals_slicing(rows, slice_bytes):
    texts = [r[0] for r in rows]
    pre = [min(r[1], len(r[0])) for r in rows]
    mid = [min(r[2], len(r[0]) - p) for r, p in zip(rows, pre)]
    form = [r[3] for r in rows]
    out = fim.rearrange(pa.array(texts, pa.string()), pa.array(form, pa.string()), pa.array(pre, pa.int64()),
                        pa.array(mid, pa.int64()), slice_bytes).to_pylist()
    for x, p, m, f, o in zip(texts, pre, mid, form, out):
        a, b, c = x[:p], x[p:p + m], x[p + m:]
        assert o == {"plain": x, "psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[f]


def test_units_share_the_bytes_of_a_sliced_column():
    texts = pa.array(["xx", "é漢", "", "😀b"], pa.large_string()).slice(1)
    assert fim.split_units(texts).to_pylist() == [["é", "漢"], [], ["😀", "b"]]


@pytest.mark.parametrize("slice_bytes", [fim.SLICE_BYTES, 1000])
def test_odd_documents(spark, odd_docs, slice_bytes):
    more = spark.createDataFrame([(20 + i, "a <P> b" if i == 0 else "<S" * i + "é<", None, None, "", 0, "", "", "")
                                  for i in range(30)], odd_docs.schema)
    docs = odd_docs.union(more)
    rows = fim.transform(docs, slice_bytes=slice_bytes, keep=["doc_id", "text", "size"]).collect()
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: tuple(str(v) for v in r)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows), key=key)
    assert got == sorted(((i, *expected(i, x)) for i, x in source), key=key)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_outputs_give_the_texts_back(spark, odd_docs):
    rows = fim.digests(fim.transform(odd_docs)).collect()
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    assert sorted(r["restored_sha256"] for r in rows) == sorted(sha(r["text"]) for r in odd_docs.collect())


def test_no_rows(no_docs):
    assert fim.digests(fim.transform(no_docs)).collect() == []
