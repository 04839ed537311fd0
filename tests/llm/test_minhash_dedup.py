"""Components against all pairs, sketches against exact similarity."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemirror.llm import minhash_dedup as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_force(rows):
    """Component of each id, rows that share an id united."""
    rows = [(i, shingle_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in root}


def corpus(seed, bases=12, copies=8, hot=120):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 7)))
    rows, common = [], " ".join(word() for _ in range(25))

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[draw.randrange(len(words))] = word()
        return " ".join(words)

    for n in range(bases):
        base = [word() for _ in range(draw.choice([1, 3, 5, 8, 20, 60, 150, 400]))]
        for _ in range(copies):
            text = edited(base, draw.randrange(4) if len(base) > 8 else draw.randrange(2))
            rows.append(text if draw.random() < 0.7 else text.upper() + " \n")
        if n % 3 == 0:
            rows += [common + " " + " ".join(word() for _ in range(20)) for _ in range(4)]
    group = [word() for _ in range(120)]
    rows += [edited(group, draw.randrange(6)) for _ in range(hot)]
    rows += [" ".join(group)] * 30
    draw.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_agree_with_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16 if seed == 1 else 1024)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    got = {r["doc_id"]: r for r in M.near_duplicates(docs).collect()}
    want = brute_force(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    for i, text in rows:
        assert got[i]["n_shingles"] == len(shingle_set(text)) and got[i]["kept"] == (want[i] == i)


def test_odd_documents_and_an_empty_table(odd, none):
    got = M.near_duplicates(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute_force(rows)
    told = got.collect()
    assert len(told) == len(rows)
    for r in told:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    assert M.near_duplicates(none).count() == 0


def test_sketches_estimate_similarity_and_bands_meet():
    draw = np.random.default_rng(4)
    for size in (6, 40, 146, 500, 4000):
        met = 0
        for _ in range(40):
            shared = draw.integers(0, 2**63, size * 18 // 20).astype(np.uint64) * np.uint64(2)
            a, b = (np.unique(np.concatenate([shared, draw.integers(0, 2**63, size // 20).astype(np.uint64) * np.uint64(2) + np.uint64(k)])) for k in (0, 1))
            x, y = (np.frombuffer(M.sketch(s), "<u2") for s in (a, b))
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert exact >= 0.85
            equal, filled = ((x == y) & (x > 0)).sum(), ((x > 0) | (y > 0)).sum()
            assert M.probable(equal, filled, np.array(len(a), float), np.array(len(b), float))
            met += bool((M.band_hashes(x) == M.band_hashes(y)).any())
        assert met == 40
    unlike = [np.unique(draw.integers(0, 2**63, 600).astype(np.uint64) * np.uint64(2)) for _ in range(2)]
    x, y = (np.frombuffer(M.sketch(s), "<u2") for s in unlike)
    assert not M.probable(((x == y) & (x > 0)).sum(), ((x > 0) | (y > 0)).sum(), np.array(600.0), np.array(600.0))


def test_registers_hold_leading_zeros_and_mantissa():
    h = np.array([(3 << 56) | (1 << 40)], np.uint64)
    registers = np.frombuffer(M.sketch(h), "<u2")
    # Bucket 3; of the 56 bits below, 15 zeros lead and the mantissa is 0.
    assert registers[3] == (15 + 1) << M.MANTISSA and (registers > 0).sum() == 1
    assert not np.frombuffer(M.sketch(np.zeros(0, np.uint64)), "<u2").any()
    assert len(M.shingles(pa.array(["a b c", "a b c d e f", None]))[1]) == 2


def test_members_of_the_main_component_meet_strays_alone(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 10)
    hits = spark.createDataFrame([(7, 0, rep) for rep in range(1000)], "band BIGINT, nth INT, rep BIGINT")
    components = spark.createDataFrame([(rep, 0) for rep in range(985)], "node BIGINT, component BIGINT")
    rows = M.meetings(hits, components).collect()
    # 985 in 99 blocks meet the two blocks of 15 strays, which meet all 101.
    assert len(rows) == 985 * 2 + 15 * 101
    where = {}
    for r in rows:
        where.setdefault(r["rep"], set()).add((r["i"], r["j"]))
    assert all(where[a] & where[b] for a in range(985, 1000) for b in range(1000))
