"""Words, hashes and slices of Arrow texts against Python's own."""

import random
import re

import numpy as np
import pyarrow as pa

from tidemirror.llm import texts as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, " ", "a", "a b", " äö  x\n", "x y z \x1c", "\t\v\f\r", "日本 語", "end", "w" * 5000 + " v"]


def words(column):
    data, offsets = X.flat(column)
    starts, ends = X.runs(~X.is_space(data), offsets)
    bounds = X.counts_by_text(starts, offsets)
    raw = data.tobytes()
    return [[raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(bounds, bounds[1:])]


def test_words_of_odd_texts_and_of_slices():
    column = pa.array(ODD)
    want = [WORD.findall(t or "") for t in ODD]
    assert words(column) == want
    assert words(column.slice(3, 5)) == want[3:8]
    assert words(pa.array([], pa.string())) == []


def test_hashes_depend_on_the_word_alone(monkeypatch):
    draw = random.Random(1)
    texts = [" ".join(draw.choice(["a", "b", "ab", "ba", "longer", "é"]) for _ in range(40)) for _ in range(30)]

    def hashes(column):
        data, offsets = X.flat(column)
        return X.hash_runs(data, *X.runs(~X.is_space(data), offsets))

    whole = hashes(pa.array(texts))
    flat = [w for t in texts for w in t.split()]
    seen = {}
    for w, h in zip(flat, whole.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    monkeypatch.setattr(X, "_PIECE", 7)
    assert np.array_equal(hashes(pa.array(texts)), whole)


def test_slices_hold_every_row_once_and_bounded_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["x" * n for n in (3, 9, 1, 1, 50, 2, 2, 2)])], ["i", "t"])
    parts = list(X.slices([batch, batch.slice(0, 0)], "t", limit=10))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(8))
    assert all(p.num_rows == 1 or sum(map(len, p.column("t").to_pylist())) <= 10 for p in parts)
