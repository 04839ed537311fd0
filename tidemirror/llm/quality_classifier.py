"""Quality classifier by importance resampling.

Two generative models over hashed word unigrams and bigrams, one of target texts and one
of all raw texts, give every document the logarithm of its importance weight: how much
likelier its n-grams are in target than in raw text. The mean over n-grams is taken as
that of a document of ``length`` n-grams, so long documents are not judged by their
length. A sample without replacement, in proportion to the weights, is the top ``share``
of documents by log weight plus a Gumbel number drawn from the document's id.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.texts import counts_by_text, flat, hash_runs, hash_windows, is_space, lower_ascii, runs, slices, with_fields
from tidemirror.operators.upsert import surrogate_keys

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    """``targets`` bounds the labelled documents that the target model is made from."""

    buckets: int = 1 << 16
    targets: int = 20_000
    smoothing: float = 0.5
    length: float = 100.0
    share: float = 0.8
    seed: int = 5


def n_grams(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word and word pair, and the text it belongs to."""
    data, offsets = flat(column)
    data = lower_ascii(data)
    starts, ends = runs(~is_space(data), offsets)
    bounds = counts_by_text(starts, offsets)
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    words = hash_runs(data, starts, ends)
    pairs = hash_windows(words, 2)
    own = text_of[:-1] == text_of[1:] if len(words) else np.zeros(0, bool)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    both = np.concatenate([words, pairs[own]]) >> shift
    return both.astype(np.int64), np.concatenate([text_of, text_of[:-1][own]])


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts; every task sends ``buckets`` numbers at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(n_grams(batch.column("text"), buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets)
    for bucket, n in texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    """Per bucket, the log of its probability in target text over that in raw text."""
    share = lambda c: (c + smoothing) / (c.sum() + smoothing * len(c))
    return np.log(share(target)) - np.log(share(raw))


def weights(docs: DataFrame, ratio: np.ndarray, settings: Settings) -> DataFrame:
    """``doc_id`` and ``log_weight``; a text without words has none (null)."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))

    def run(batches):
        for batch in slices(batches, "text"):
            buckets, text_of = n_grams(batch.column("text"), len(sent.value))
            n = np.bincount(text_of, minlength=batch.num_rows)
            sums = np.bincount(text_of, sent.value[buckets].astype(float), minlength=batch.num_rows)
            mean = pa.array(settings.length * sums / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), mean], ["doc_id", "log_weight"])

    return docs.mapInArrow(run, with_fields(docs.drop("text").schema, log_weight="double"))


def resample(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``log_weight``, ``key`` and ``kept``.

    ``target_ids`` (a column ``doc_id``) names documents of the wanted kind; the first
    ``settings.targets`` by hash are used. ``kept`` marks the ``share`` of documents with the
    largest keys, ties going to the smaller id. A null or blank text has a null weight and key
    and comes last. Repeated rows are rows of their own; a row without an id draws the same
    number as all such rows. Without target documents all weights are equal. An empty table
    gives an empty result, other columns are ignored.
    """
    s = settings or Settings()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    picked = target_ids.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(s.targets)
    # At most ``targets`` ids.
    target = bucket_counts(rows.join(F.broadcast(picked), "doc_id", "left_semi"), s.buckets)
    raw = bucket_counts(rows, s.buckets)
    ratio = log_ratio(target, raw, s.smoothing) if target.any() else np.zeros(s.buckets)
    even = (F.pmod(F.xxhash64("doc_id", F.lit(s.seed + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    scored = weights(rows, ratio, s).withColumn("key", F.col("log_weight") - F.log(-F.log(even)))
    ranked = surrogate_keys(scored, [F.desc_nulls_last("key"), F.asc_nulls_last("doc_id")], column="_place")
    keep = math.ceil(s.share * ranked.count())
    return ranked.select("doc_id", "log_weight", "key", (F.col("_place") <= keep).alias("kept"))
