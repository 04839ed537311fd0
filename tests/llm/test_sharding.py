"""Packing against a plain loop, balance, groups kept together, slots."""

import collections
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemirror.llm import sharding as S

VECTORS = st.lists(st.tuples(*[st.integers(0, 8).map(lambda x: x / 8)] * 3), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(VECTORS, st.integers(1, 6), st.integers(0, 99))
def test_each_item_goes_where_the_product_is_highest(vectors, shards, seed):
    items, weights = np.array(vectors), np.array([8.0, 1.0, 1.0])
    got = S.place(items, np.ones((shards, 3)), weights, seed)
    left = [[1.0] * 3 for _ in range(shards)]
    for item, at in zip(vectors, got, strict=True):
        products = [sum(w * x * y for w, x, y in zip(weights, item, own, strict=True)) for own in left]
        assert products[at] >= max(products) - 1e-9
        left[at] = [y - x for x, y in zip(item, left[at], strict=True)]


def spread(spark, n, **more):
    """Documents of very unlike lengths; every tenth text occurs twice."""
    at = F.col("id") - F.when(F.col("id") % 10 == 1, 1).otherwise(0)
    text = F.concat(F.lit("text "), at.cast("string"), F.expr("repeat(' word', cast(pow(pmod(xxhash64({0}), 1000) / 100, 3) as int))".format("id - if(id % 10 = 1, 1, 0)")))
    return spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))


def checked(docs, rows, shards):
    """Every row has its place, size and checksum; the loads of all shards."""
    want = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    assert {(r["law"], r["grown_shard"]) for r in rows} <= {("bytes", None)}
    loads = np.zeros((shards, 2))
    for r in rows:
        loads[r["shard"]] += [r["size"], 1]
    return loads


def test_shards_are_even_and_groups_stay_together(spark):
    docs = spread(spark, 20_000)
    rows = S.assign(docs).collect()
    loads = checked(docs, rows, 40)
    assert np.abs(loads[:, 0] / loads[:, 0].mean() - 1).max() < 0.01
    assert np.abs(loads[:, 1] / loads[:, 1].mean() - 1).max() < 0.05
    of = collections.defaultdict(set)
    for r in rows:
        of[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())
    again = S.assign(docs).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in again) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows)


def test_hot_group_is_dealt_out(spark):
    """A text with a third of all rows, among them many that share an id or have none."""
    hot = spark.range(5_000).select(F.when(F.col("id") > 2_000, F.col("id")).when(F.col("id") > 1_000, 7).alias("doc_id"), F.lit("the same text").alias("text"))
    docs = spread(spark, 10_000).unionByName(hot)
    rows = S.assign(docs).collect()
    loads = checked(docs, rows, 40)
    assert np.abs(loads[:, 0] / loads[:, 0].mean() - 1).max() < 0.02
    assert np.abs(loads[:, 1] / loads[:, 1].mean() - 1).max() < 0.06


def test_odd_documents_and_an_empty_table(odd, none):
    packing = S.Packing(shards=3)
    got = S.assign(odd, packing=packing)
    assert got.columns == [*[c for c in odd.columns if c not in S.ADDED], *S.ADDED]
    rows = got.collect()
    checked(odd, rows, 3)
    assert all(r["rank"] == "rank" and r["key"] == "key" for r in rows)
    assert S.assign(none).collect() == []


def test_files_by_shard(spark, tmp_path):
    docs = spread(spark, 500)
    assigned = S.assign(docs, packing=S.Packing(shards=4))
    S.write(assigned, str(tmp_path / "shards"), rows_per_file=50)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select("doc_id", "text", "shard", "slot").collect())) == sorted(map(tuple, assigned.select("doc_id", "text", "shard", "slot").collect()))
    assert back.select("shard").distinct().count() == 4


def test_query_gives_every_document_a_slot(spark, sf):
    from tidemirror.llm.queries import QUERIES

    rows = QUERIES["op11_shard"](spark, sf)
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    checked(spark.read.parquet(f"{sf}/documents.parquet"), rows.collect(), 40)
