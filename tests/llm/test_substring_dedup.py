"""Removed sentences against a plain search of repeated spans."""

import random
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemirror.llm import substring_dedup as S


def plain_spans(parts, least):
    """All runs of ``least`` words that lose them without their first or without their last sentence."""
    words = [len(p.split()) for p in parts]
    runs = [(a, b) for a in range(len(parts)) for b in range(a + 1, len(parts) + 1) if words[a] and words[b - 1] and sum(words[a:b]) >= least]
    return [(a, b) for a, b in runs if sum(words[a + 1 : b]) < least or sum(words[a : b - 1]) < least]


def brute_force(rows, least=S.WORDS):
    rows = sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0))
    holder, out = {}, {}
    for i, text in rows:
        parts = S.sentences(text)
        gone, firsts = set(), set()
        for n, (a, b) in enumerate(plain_spans(parts, least)):
            first = holder.setdefault(tuple(" ".join(p.split()) for p in parts[a:b]), (i, n))
            if first != (i, n):
                gone |= set(range(a, b))
                firsts.add(first[0])
        out[i, text] = ("".join(p for k, p in enumerate(parts) if k not in gone), len(gone), firsts)
    return out


@given(st.text("ab.!? \n\t", max_size=60))
def test_sentences_make_up_the_text(text):
    parts = S.sentences(text)
    assert "".join(parts) == text and all(parts)


@given(st.lists(st.integers(0, 9), max_size=12), st.integers(1, 20))
def test_spans_are_the_shortest_runs_from_either_end(counts, least):
    parts = ["w " * n + ". " if n else " " for n in counts]
    parts = [p.replace(" . ", ". ") for p in parts]
    got = [tuple(map(int, s)) for s in zip(*S.spans(parts, least))]
    assert got == sorted(plain_spans(parts, least)) and len(set(got)) == len(got)


def test_sentences_and_spans():
    assert S.sentences("One. Two!  Three?\nFour") == ["One. ", "Two!  ", "Three?\n", "Four"]
    starts, ends = S.spans(["a b. "] * 4, least=5)
    assert list(zip(starts.tolist(), ends.tolist())) == [(0, 3), (1, 4)]
    assert len(S.spans(["\n", "\n"])[0]) == len(S.spans([])[0]) == 0


@pytest.mark.parametrize("seed, floor", [(1, S.HOT_FLOOR), (2, 2)])
def test_cleaned_texts_agree_with_a_plain_search(spark, monkeypatch, seed, floor):
    # With the low floor, the rows of most spans are spread over salts.
    monkeypatch.setattr(S, "HOT_FLOOR", floor)
    draw = random.Random(seed)
    sentence = lambda: " ".join(draw.choice("abcdefghij") * draw.randrange(1, 4) for _ in range(draw.randrange(1, 14))) + draw.choice([". ", "! ", ".\n", "\n"])
    passages = ["".join(sentence() for _ in range(draw.randrange(2, 9))) for _ in range(6)]
    rows = [(i, "".join(draw.choice([sentence(), sentence(), draw.choice(passages)]) for _ in range(draw.randrange(8)))) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    want, texts = brute_force(rows), dict(rows)
    for r in S.dedup_spans(df).collect():
        text, removed, firsts = want.get((r["doc_id"], texts[r["doc_id"]]), ("", 0, set()))
        assert (r["text"], r["n_removed"], set(r["first_docs"] or ())) == (text, removed, firsts)


def test_planted_passages_go_whole(spark, tmp_path):
    from tidemirror.llm.queries import QUERIES

    draw, count = random.Random(7), iter(range(10**6))
    sentence = lambda n: " ".join(f"w{next(count)}" for _ in range(n)) + ". "
    # Short sentences after long ones, before them and between them.
    shapes = [(30, 4), (4, 30), (26, 26, 3), (30, 10, 10, 5), (12, 12), (3, 4, 8), (8, 8, 30, 2), (2, 40, 2), (9, 9, 9, 9)]
    passages = ["".join(sentence(n) for n in shape) for shape in shapes]
    rows, own = [], {}
    for i in range(60):
        before, after = (" ".join(f"w{next(count)}" for _ in range(draw.randrange(5, 30))) + ".\n" for _ in range(2))
        rows.append((i, before + passages[i % len(passages)] + after))
        own[i] = before + after if i >= len(passages) else rows[i][1]
    # Runs of few words stay, however often they occur.
    rows += [(100, "\n one. "), (101, "\n one. "), (102, "One two. Three four.\nAll rights reserved.\n"), (103, "One two. Three four.\nAll rights reserved.\n")]
    own |= dict(rows[-4:])
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_substring_dedup"](spark, str(tmp_path))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == own


def test_odd_documents_and_an_empty_table(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute_force(rows)
    got = S.dedup_spans(odd)
    assert got.columns == ["doc_id", "n_sentences", "n_removed", "first_docs", "text"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((i, want[i, t][0] if t else t) for i, t in rows)
    assert S.dedup_spans(none).count() == 0


def test_query_agrees_with_a_plain_search(spark, sf):
    from tidemirror.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_force(rows)
    got = {r["doc_id"]: (r["text"], r["n_removed"], set(r["first_docs"] or ())) for r in QUERIES["op4_substring_dedup"](spark, sf).collect()}
    assert got == {i: want.get((i, t), (t, 0, set())) for i, t in rows} and any(n for _, n, _ in got.values())
