"""The stages on a fixture: what each keeps, and what it returns."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tidemirror.llm import minhash_dedup as M


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out, folder = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in P.STAGES:
        stage(spark, out[-1], sf).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "minhash_dedup", "mix_sources", "bpe_encode"]
    assert all(df.columns == P.COLUMNS for df in steps[:-1])


def test_each_stage_takes_effect(spark, steps):
    docs, known, lined, single, mixed, encoded = steps
    assert known.count() == docs.where("text IS NOT NULL AND text RLIKE '\\\\p{L}'").count()
    before = {r["doc_id"]: r["text"] for r in known.collect()}
    after = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert set(after) <= set(before) and any(after[i] != before[i] for i in after)
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())
    kept = {r["doc_id"] for r in single.collect()}
    classes = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(lined).collect()}
    assert kept == {i for i, c in classes.items() if i == c}
    words = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert abs(words(mixed) / (1.5 * words(single)) - 1) < 0.02
    assert {r["doc_id"] for r in mixed.collect()} <= kept
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    rows = encoded.collect()
    assert len(rows) == mixed.count()
    for r in rows[:50]:
        ids = np.frombuffer(r["token_ids"], "<u4").tolist()
        assert ids == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids and len(ids) == r["n_tokens"]


def test_rows_without_ids_repeated_rows_and_an_empty_table(spark, odd, sf):
    docs = odd.selectExpr("doc_id", "text", "lang", "source", "length(text) AS n_chars")
    for frame in (docs, docs.limit(0)):
        for _, stage in P.STAGES:
            frame = spark.createDataFrame(stage(spark, frame, sf).collect(), stage(spark, frame, sf).schema)
        assert "token_ids" in frame.columns
    one = P.keep_one_of_each(spark, docs, sf)
    assert one.where("doc_id = 6").count() == 1 and one.where("doc_id IS NULL").count() == docs.where("doc_id IS NULL").count()
