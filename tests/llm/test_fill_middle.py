"""Cuts against a plain regular expression, round trips, odd documents."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemirror.llm import fill_middle as M

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute_force(doc_id, text, cut=90, suffix_first=20):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return len(units), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=700), st.data())
def test_skip_list_reaches_every_rank(widths, data):
    ranks = np.array(data.draw(st.lists(st.integers(0, len(widths)), min_size=1, max_size=30)))
    sums = np.concatenate([[0], np.cumsum(widths)])
    assert M.SkipList(np.array(widths)).seek(ranks).tolist() == sums[ranks].tolist()


def test_lanes_thin_out_and_a_descent_is_short():
    skip = M.SkipList(np.full(100_000, 3))
    assert [len(units) for units, _ in skip.lanes] == [100_000, 6_250, 391, 25, 2]
    assert all(units.sum() == 100_000 and widths.sum() == 300_000 for units, widths in skip.lanes)


TEXTS = st.lists(st.one_of(st.none(), st.text("aZ é\n\r#<PSM>日😀0", max_size=60)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_agree_with_a_regular_expression(texts, first, second):
    ranks = [np.full(len(texts), h, np.int64) for h in (first, second)]
    n, prefix, middle = M.cuts(pa.array(texts, pa.string()), *ranks)
    for i, text in enumerate(texts):
        units = UNIT.findall(text or "")
        low, high = sorted(h % (len(units) + 1) for h in (first, second))
        assert (n[i], prefix[i], middle[i]) == (len(units), len("".join(units[:low])), len("".join(units[low:high])))


def test_odd_documents_and_an_empty_table(odd, none):
    made = M.transform(odd).withColumn("back", M.restored())
    assert made.columns == [*[c for c in odd.columns if c not in M.ADDED], *M.ADDED, "back"]
    rows = made.collect()
    got = collections.Counter((r["doc_id"], r["text"], *(r[c] for c in M.ADDED)) for r in rows)
    assert got == collections.Counter((r["doc_id"], r["text"], *brute_force(r["doc_id"], r["text"])) for r in odd.collect())
    assert all(r["back"] == (r["text"] or "") and r["rank"] == "rank" for r in rows)
    assert M.transform(none).collect() == []


def test_markers_and_their_parts_survive(spark):
    pieces = ["<", "P", ">", "<P", "S>", "<S>", "a b", "<M", "", "é😀"]
    texts = [x + y + z for x in pieces for y in pieces for z in pieces]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    always = M.Settings(cut=100, suffix_first=50)
    for r in M.transform(docs, settings=always).withColumn("back", M.restored()).collect():
        want = brute_force(r["doc_id"], r["text"], 100, 50)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["back"] == r["text"]


def test_very_long_text(spark):
    text = "word, é " * 300_000
    docs = spark.createDataFrame([(1, text), (4, text)], "doc_id BIGINT, text STRING")
    for r in M.transform(docs).withColumn("same", M.restored() == F.col("text")).collect():
        assert r["same"] and tuple(r[c] for c in M.ADDED) == brute_force(r["doc_id"], text)


def test_query_agrees_with_brute_force(spark, sf):
    from tidemirror.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_fill_middle"](spark, sf).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in rows:
        *want, output = brute_force(r["doc_id"], docs[r["doc_id"]])
        assert list(r) == [r["doc_id"], *want, sha(output), sha(docs[r["doc_id"]] or "")]
    assert len(rows) == len(docs)
