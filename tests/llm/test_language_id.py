"""Held-out accuracy, calibration and edge cases of language identification."""

import math
import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemirror.llm import language_id as L


def test_query_is_accurate_on_held_out_documents(spark, sf):
    from tidemirror.llm.queries import QUERIES

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    known = {r["lang"] for r in docs.values()}
    right = []
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in known | {"und"} and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not L.has_letter(docs[r["doc_id"]]["text"]))
        if r["held_out"]:
            right.append(r["lang_pred"] == docs[r["doc_id"]]["lang"])
    assert np.mean(right) >= 0.95


@pytest.fixture(scope="module")
def model(spark, sf):
    return L.fit(spark.read.parquet(f"{sf}/documents.parquet"), settings=L.Settings(sample=80))


def test_weights_are_sparse_and_runs_agree(spark, sf, model):
    assert (model.weights == 0).mean() > 0.3 and model.temperature > 0
    again = L.fit(spark.read.parquet(f"{sf}/documents.parquet").repartition(5), settings=L.Settings(sample=80))
    assert np.array_equal(model.idf, again.idf) and np.array_equal(model.weights, again.weights)


def test_document_frequencies_cover_all_rows(spark):
    texts = ["ab", "abab", "b c", "É"]
    s = L.Settings(buckets=256)
    df = spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(3)
    found, n = L.document_frequencies(df, s)
    assert n == 4 and np.array_equal(found, sum((L.counts(t, s) > 0).astype(int) for t in texts))


def test_odd_documents_and_an_empty_table(odd, none, model):
    got = L.predict(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["row"] == "row" and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not L.has_letter(r["text"]))
    assert L.predict(none, model).count() == 0
    nothing = L.fit(none)
    assert {r["lang_pred"] for r in L.predict(odd, nothing).collect()} == {"und"}
    one = L.fit(odd.where("lang = 'es'"))
    assert {r["lang_pred"] for r in L.predict(odd, one).collect()} == {"es", "und"}


def test_the_language_column_is_no_input_of_a_prediction(odd, model):
    plain = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in L.predict(odd, model).collect()}
    other = L.predict(odd.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")), model).collect()
    assert {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in other} == plain


def test_temperature_minimises_the_log_loss():
    draw = np.random.default_rng(1)
    logits = draw.standard_normal((4000, 3)) * 2
    labels = np.array([draw.choice(3, p=p) for p in L.softmax(logits / 3.0)])
    assert math.isclose(L.temperature(logits, labels), 3.0, rel_tol=0.15)
    assert L.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_training_follows_the_regularised_leader():
    """One feature, one row: the closed form of the first two steps."""
    s = L.Settings(buckets=2, epochs=1, l1=0.0, l2=0.0)
    w, b = L.train([(np.array([0]), np.array([1.0]))], np.array([1]), 2, s)
    # The gradient is -0.5 for the right class, and z is that gradient.
    want = 0.5 / ((s.beta + 0.5) / s.alpha)
    assert np.allclose(w[0], [-want, want]) and np.allclose(b, [-want, want]) and not w[1].any()
    strict = L.Settings(buckets=2, epochs=1, l1=1.0)
    assert not L.train([(np.array([0]), np.array([1.0]))], np.array([1]), 2, strict)[0].any()


def test_rows_without_ids_are_sampled_one_by_one(spark):
    rows = [(None, f"{w} {w} {i}", lang) for i in range(2000) for w, lang in (("alpha beta", "en"), ("zeta óñ", "es"))]
    df = spark.createDataFrame([*rows, *[(None, "one text", "en")] * 2000], "doc_id BIGINT, text STRING, lang STRING")
    model = L.fit(df, settings=L.Settings(sample=200))
    assert model.languages == ["en", "es"]
    got = L.predict(spark.createDataFrame([(1, "alpha beta alpha"), (2, "zeta óñ zeta")], "doc_id BIGINT, text STRING"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in got.collect()} == {1: "en", 2: "es"}


def test_scores_agree_with_a_plain_recomputation(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)

    def plain(text):
        points, found = [ord(c) for c in text.lower()], {}
        for order in range(1, model.settings.orders + 1):
            for k in range(len(points) - order + 1):
                gram = 0
                for point in points[k : k + order]:
                    gram = (gram * 0x100000001B3 + point) % 2**64
                bucket = (gram + order) * 0x9E3779B97F4A7C15 % 2**64 >> 50
                found[bucket] = found.get(bucket, 0) + 1
        weighted = {b: (1 + math.log(c)) * model.idf[b] for b, c in found.items()}
        length = math.sqrt(sum(v * v for v in weighted.values()))
        logits = [model.bias[k] + sum(v / length * model.weights[b][k] for b, v in weighted.items()) for k in range(len(model.languages))]
        odds = [math.exp((z - max(logits)) / model.temperature) for z in logits]
        return model.languages[odds.index(max(odds))], max(odds) / sum(odds)

    for r in L.predict(docs, model).collect():
        if L.has_letter(r["text"]):
            lang, score = plain(r["text"])
            assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9


def test_many_rare_labels_do_not_crowd_out_the_large_ones(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rare = spark.range(7000).select((F.col("id") + 10_000_000).alias("doc_id"), F.concat(F.lit("rare text "), F.col("id").cast("string")).alias("text"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("lang"))
    model = L.fit(docs.unionByName(rare), settings=L.Settings(sample=200, languages=8))
    known = {r["lang"] for r in docs.select("lang").where("lang IS NOT NULL").distinct().collect()}
    assert known <= set(model.languages) and len(model.languages) == 8
    got = L.predict(docs, model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got if r["lang"]]) > 0.9


OUTSIDE = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", sys.argv[1]).getOrCreate()
sys.path.insert(0, sys.argv[2])
from tidemirror.llm import language_id as L
docs = spark.createDataFrame([(i, t, l) for i in range(20) for t, l in ((f"the cat and {i}", "en"), (f"le chat et {i}", "fr"))], "doc_id int, text string, lang string")
found = L.predict(docs, L.fit(docs)).collect()
print(sum(r["lang"] == r["lang_pred"] for r in found))
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    (tmp_path / "outside.py").write_text(OUTSIDE)
    root = Path(L.__file__).resolve().parents[2]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "outside.py", str(tmp_path / "warehouse"), str(root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("40"), done.stderr[-2000:]
