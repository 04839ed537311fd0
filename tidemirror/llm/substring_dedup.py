"""Substring dedup by sliding spans of sentences.

A sentence ends with its closing marks or its line. A span is a run of consecutive sentences
that holds at least ``WORDS`` words: from every sentence the shortest such run that begins
there, and the shortest that ends there. A longer run is covered by these, which are repeated
and later wherever it is. All spans are hashed and joined over all documents; sentences that
any span but the first of its kind covers are removed.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import stored
from tidemirror.llm.texts import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 15
# Rows of the span join are spread if more than a share of all repeated ones, and no fewer than
# the floor, have one span, so at most ``HOT_SPANS`` spans are ever broadcast.
HOT_SPANS = 10_000
HOT_FLOOR = 4096
# What ends a sentence, with the white space after it.
END = re.compile(r"[.!?]+\s+|\n\s*")


def sentences(text: str | None) -> list[str]:
    """A text cut into sentences that, put together, are the text again."""
    if not text:
        return []
    ends = [m.end() for m in END.finditer(text)]
    bounds = [0, *ends, *([len(text)] if not ends or ends[-1] < len(text) else [])]
    return [text[a:b] for a, b in zip(bounds, bounds[1:])]


def spans(parts: list[str], least: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last sentence of every span, without repeats.

    Sentences without a word, which only begin a text, are in no span.
    """
    total = np.concatenate([[0], np.cumsum([len(p.split()) for p in parts], dtype=np.int64)])
    at = np.arange(len(parts))
    worded = total[1:] > total[:-1]
    end = np.searchsorted(total, total[:-1] + least, "left")
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    begins, ends = worded & (end <= len(parts)), worded & (start >= 0)
    found = np.unique(np.concatenate([at[begins] * (len(parts) + 1) + end[begins], start[ends] * (len(parts) + 1) + at[ends] + 1]))
    return found // (len(parts) + 1), found % (len(parts) + 1)


def _span_rows(text: str | None, least: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Hashes of 128 bits, one after the other, and bounds of a text's spans."""
    import xxhash

    parts = sentences(text)
    start, end = spans(parts, least)
    own = [xxhash.xxh3_128_digest(" ".join(p.split()).encode("utf-8", "surrogatepass")) for p in parts] if len(start) else []
    hashes = b"".join([xxhash.xxh3_128_digest(b"".join(own[a:b])) for a, b in zip(start.tolist(), end.tolist())])
    return hashes, start.astype(np.int32), end.astype(np.int32)


def dedup_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_removed``, ``first_docs`` and the remaining ``text`` of every document.

    The first of equal spans is that of the smallest id (null last), then of the smaller
    text hash, then the earlier one; ``first_docs`` lists the documents that hold the first
    copies of what was removed. Sentences are compared up to white space. A null text stays
    null and an empty one empty. Rows that repeat id and text get the same result; an empty
    table gives an empty result, other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumns(
        {"doc": F.coalesce("doc_id", F.lit(2**63 - 1)), "row": F.xxhash64("doc_id", "text")}
    )
    place, span = ["doc", "row", "start"], ["high", "low"]

    def cut(batches):
        for batch in slices(batches, "text"):
            got = [_span_rows(t, least) for t in batch.column("text").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(got)), [len(g[1]) for g in got]))
            halves = np.frombuffer(b"".join([g[0] for g in got]), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column("doc").take(at), batch.column("row").take(at),
                 pa.array(np.concatenate([g[1] for g in got])), pa.array(np.concatenate([g[2] for g in got]))],
                [*span, *place, "end"],
            )

    every = rows.select("doc", "row", "text").mapInArrow(cut, "high bigint, low bigint, doc bigint, row bigint, start int, end int")
    shared = every.groupBy(*span).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("first")).where("n > 1")
    shared = stored(shared, "span-firsts")
    limit = max(HOT_FLOOR, (shared.agg(F.sum("n")).first()[0] or 0) // HOT_SPANS)
    # A hot span's first place is written once per salt; its rows draw one of them.
    salts = F.when(F.col("n") > limit, F.ceil(F.col("n") / limit)).otherwise(1)
    firsts = shared.select(*span, "first", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt"))
    hot = F.broadcast(shared.where(F.col("n") > limit).select(*span, salts.alias("salts")))
    salted = every.join(hot, span, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(*place), "salts"), F.lit(0).cast("bigint")))
    later = salted.join(firsts, [*span, "salt"]).where(F.struct(*place) > F.col("first"))
    covered = F.explode(F.sequence("start", F.col("end") - 1))
    gone = later.select("doc", "row", covered.alias("at"), F.col("first.doc").alias("from"))
    gone = stored(gone.groupBy("doc", "row").agg(F.collect_set("at").alias("gone"), F.collect_set("from").alias("first_docs")), "span-removed")
    first_docs = F.transform("first_docs", lambda d: F.when(d != 2**63 - 1, d))
    joined = rows.join(gone, ["doc", "row"], "left").select(
        "doc_id", "text", "gone", F.when(F.col("gone").isNotNull(), F.array_sort(first_docs)).alias("first_docs")
    )

    def clean(batches):
        for batch in slices(batches, "text"):
            count, removed, kept = [], [], []
            for t, out in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                parts, out = sentences(t), set(out or ())
                count.append(len(parts))
                removed.append(len(out))
                kept.append("".join([p for i, p in enumerate(parts) if i not in out]) if out else t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), batch.column("first_docs"), pa.array(kept, pa.string())],
                ["doc_id", "n_sentences", "n_removed", "first_docs", "text"],
            )

    return joined.mapInArrow(clean, "doc_id bigint, n_sentences bigint, n_removed bigint, first_docs array<bigint>, text string")
