"""Weights against plain counts, the sample against a sort, and what it keeps."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemirror.llm import quality_classifier as Q

FEW = Q.Settings(buckets=1 << 10, share=0.5)


def test_n_grams_stay_inside_their_text():
    buckets, text_of = Q.n_grams(pa.array(["a b c", None, "A", "b c"]), 1 << 16)
    assert np.bincount(text_of, minlength=4).tolist() == [5, 0, 1, 3]
    by = {i: sorted(buckets[text_of == i].tolist()) for i in range(4)}
    # The last text's words and pair are among the first one's.
    assert set(by[3]) <= set(by[0]) and by[2][0] in by[0]


def test_weights_agree_with_plain_counts(spark):
    texts = ["good words here", "bad bad bad", "good good words", None, "", "more words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(3)
    target = spark.createDataFrame([(0,), (2,), (2,), (None,), (77,)], "doc_id BIGINT")
    got = {r["doc_id"]: r for r in Q.resample(docs, target, settings=FEW).collect()}
    counts = [np.bincount(Q.n_grams(pa.array([t], pa.string()), FEW.buckets)[0], minlength=FEW.buckets) for t in texts]
    ratio = Q.log_ratio((counts[0] + counts[2]).astype(float), sum(counts).astype(float), FEW.smoothing)
    for i, c in enumerate(counts):
        if c.sum():
            assert math.isclose(got[i]["log_weight"], FEW.length * (c @ ratio) / c.sum(), rel_tol=1e-4, abs_tol=1e-4)
        else:
            assert got[i]["log_weight"] is None and got[i]["key"] is None
    assert got[2]["log_weight"] > got[1]["log_weight"]


def test_the_sample_is_the_top_share_of_the_keys(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 AND toxic = 0")
    got = Q.resample(docs, good).collect()
    assert len(got) == docs.count()
    order = sorted(got, key=lambda r: (r["key"] is None, -(r["key"] or 0), r["doc_id"]))
    keep = math.ceil(0.8 * len(got))
    assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in order[:keep]}
    again = Q.resample(docs.repartition(7), good).collect()
    assert {(r["doc_id"], r["kept"]) for r in again} == {(r["doc_id"], r["kept"]) for r in got}
    # Documents labelled bad are kept far less often than those labelled good.
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = lambda q: np.mean([r["kept"] for r in got if labels.get(r["doc_id"]) == q])
    assert kept(1) > 0.9 and kept(0) < 0.3


def test_gumbel_numbers_sample_by_weight(spark):
    """With equal weights every document is as likely as any other."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    nothing = docs.select("doc_id").limit(0)
    got = Q.resample(docs, nothing, settings=FEW).collect()
    assert {r["log_weight"] for r in got} == {0.0} and sum(r["kept"] for r in got) == 2000
    halves = sum(r["kept"] for r in got if r["doc_id"] < 2000)
    assert 900 < halves < 1100


def test_odd_documents_and_an_empty_table(odd, none):
    ids = odd.select("doc_id")
    got = Q.resample(odd, ids, settings=FEW)
    assert got.columns == ["doc_id", "log_weight", "key", "kept"]
    assert got.count() == odd.count() and got.where("kept").count() == math.ceil(odd.count() / 2)
    assert Q.resample(none, ids, settings=FEW).count() == 0
