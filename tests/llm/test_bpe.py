"""Encoding and decoding against the tokenizers library."""

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemirror.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "  ", "ΑΣ ΟΔΟΣ Σ", "İstanbul", "é Å é", "a\x1cb\x1d", "x<|endoftext|>Y <|startoftext|>", "日本語テキスト", "🏴‍☠️ 👍🏽",
    "don't I'LL 'S''s", "²½³ 12345 Ⅷ", "​ 　z", "a" * 300 + "é" * 100, "ﬁ ſ K Å", "العربية", "한국어 각",
    "\x00\x01", "﻿hi", "a\u0085b", "ᾈ ǅ", "<|endoftext|><|endoftext|>", "<|endof", "abc" * 500, "### $$$ a%%%b", "x" * 5000,
]


@pytest.fixture(scope="module")
def ours():
    return bpe.Codec(Path(PATH).read_bytes())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    draw = random.Random(3)
    ranges = [(0, 127), (0x80, 0x250), (0x250, 0x3000), (0x3000, 0xD800), (0xE000, 0x1FFFF)]
    return ["".join(chr(draw.randrange(*draw.choice(ranges))) for _ in range(40)) for _ in range(n)]


def test_ids_and_texts_are_the_library_s(ours, library):
    for text in [*ODD, *random_texts(300)]:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = ours.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert ours.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_forced_boundaries_change_nothing(ours):
    """A word encoded whole, and cut where no token reaches across, has the same ids."""
    whole = bpe.Codec(Path(PATH).read_bytes())
    whole.cuts = lambda symbols: []
    cut = 0
    for text in ["$$$###123abc!!!", "zzqxjkvwq", "ÿþýÿ", *random_texts(50)]:
        assert whole.encode(text) == ours.encode(text)
        for word in ours._words_of(text) if " " not in text else []:
            cut += len(ours.cuts([ours.inner[b] for b in word]))
    assert cut > 0


def test_kept_pieces_are_bounded(ours, monkeypatch):
    made = []
    kept = bpe.Kept(lambda k: made.append(k) or k.encode(), 6 * 200)
    keys = [f"k{i}" for i in range(20)]
    for k in keys:
        assert kept["common"] == b"common" and kept[k] == k.encode()
        assert len(kept) <= 3 and len(kept.older) <= 3
    # What is asked for all the time is made once.
    assert made.count("common") == 1 and len(made) == 21
    # A text without spaces is one piece; it is made anew each time.
    assert kept["x" * 1000] == b"x" * 1000 and "x" * 1000 not in kept


def test_documents(spark, odd, none, library):
    encoded = bpe.encode_documents(odd, PATH)
    rows = bpe.decode_documents(encoded, PATH).withColumns({"n": bpe.n_tokens(), "ids": bpe.unpack()}).collect()
    assert len(rows) == odd.count()
    assert set(encoded.columns) == set(odd.columns)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n"], r["decoded"]) == (ids, len(ids), library.decode(ids, skip_special_tokens=False))
    assert bpe.decode_documents(bpe.encode_documents(none, PATH), PATH).count() == 0
    strange = spark.createDataFrame([(None,), (bytearray(np.array([5, 10**8], "<u4").tobytes()),)], "token_ids BINARY")
    assert [r[0] for r in bpe.decode_documents(strange, PATH).select("decoded").collect()] == ["", "&"]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="pre-tokenizer"):
        bpe.Codec(Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes())


def test_query_agrees_with_the_library(spark, sf, library):
    import hashlib

    from tidemirror.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_sha256"], got[r["doc_id"]]["decoded_sha256"]) == want
