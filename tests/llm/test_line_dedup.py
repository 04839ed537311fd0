"""Deleted lines against a plain search of repeated runs; intervals against equal prefixes."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemirror.llm import line_dedup as D

SOLID = re.compile(D.NOT_BLANK)


def n_words(line):
    return len(line.split()) if any(c.isalpha() for c in line) else 0


def brute_force(rows, min_words, max_copies=None):
    """Cleaned text of every (id, text), lines removed and the longest deleted run: maximal runs by comparison with all earlier places."""
    rows = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    lines = {r: [(p, x) for p, x in enumerate(r[1].split("\n")) if SOLID.search(x)] for r in rows}
    places, out = defaultdict(list), {}
    copies = Counter(x for own in lines.values() for _, x in own)
    for r in rows:
        own, gone, longest = [x for _, x in lines[r]], set(), 0
        for k, line in enumerate(own):
            most = 0
            for other, at in places[line]:
                theirs = lines[other]
                n = 0
                while k + n < len(own) and at + n < len(theirs) and theirs[at + n][1] == own[k + n]:
                    n += 1
                most = max(most, n)
            places[line].append((r, k))
            often = max_copies is not None and most and n_words(line) and copies[line] > max_copies
            for n in {most if sum(map(n_words, own[k : k + most])) >= min_words else 0, int(bool(often))}:
                gone |= {p for p, _ in lines[r][k : k + n]}
                longest = max(longest, n)
        out[r] = ("\n".join(x for p, x in enumerate(r[1].split("\n")) if p not in gone), len(gone), longest)
    return out


def corpus(seed, n=40):
    draw = random.Random(seed)
    passages = [[f"line {draw.randrange(9)} of passage {k}" + " long" * draw.choice([0, 9]) for _ in range(draw.randrange(1, 12))] for k in range(5)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(draw.randrange(6)):
            text += draw.choice([["own " + str(draw.random())], [""], ["short"], draw.choice(passages), draw.choice(passages)[:3], [" \t"]])
        rows.append((i, "\n".join(text)))
    return rows + [(100 + i, rows[3][1]) for i in range(4)] + [(200, "same\n" * 40)]


@pytest.mark.parametrize("seed, min_words, max_copies", [(1, 5, None), (2, 12, None), (3, 30, 9), (4, 1, None), (7, 60, None)])
def test_cleaned_texts_agree_with_a_plain_search(spark, seed, min_words, max_copies):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    got = D.dedup_lines(df, min_words=min_words, max_copies=max_copies).collect()
    want = brute_force(rows, min_words, max_copies)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["text"], r["n_removed"], r["run_lines"]) == want[r["doc_id"], texts[r["doc_id"]]], r["doc_id"]


def test_intervals_are_the_suffixes_that_share_a_prefix(spark):
    rows = corpus(5, 25)
    df = spark.createDataFrame([(i, i, t) for i, t in rows], "doc BIGINT, row BIGINT, text STRING")
    lines = {i: [x for x in t.split("\n") if SOLID.search(x)] for i, t in rows}
    levels = D.intervals(D.lines(df))
    assert len(levels) == 6
    for k, level in enumerate(levels):
        prefixes = defaultdict(list)
        for i, own in lines.items():
            for at in range(len(own) - (1 << k) + 1):
                prefixes[tuple(own[at : at + (1 << k)])].append((i, at))
        want = {min(p): sorted(p) for p in prefixes.values() if len(p) > 1}
        found = defaultdict(list)
        for r in level.collect():
            found[r["first"]["doc"], r["first"]["seq"]].append((r["doc"], r["seq"]))
        assert {first: sorted(p) for first, p in found.items()} == want


def test_every_round_decides(spark):
    """Runs of two-word lines count by all their lines, so their exact length is needed."""
    lines = [f"word {k}" for k in range(13)]
    shared = lambda n: "\n".join(lines[:n])
    rows = [(0, shared(13)), *[(n, f"own text {n}\n" + shared(n)) for n in range(1, 14)]]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    gone = {}
    for rounds in (0, 1, 2, 62):
        gone[rounds] = {r["doc_id"] for r in D.dedup_lines(df, min_words=22, rounds=rounds).collect() if r["n_removed"]}
    # With prefixes of up to 2, 4 and 8 lines, runs are followed for 1, 3, 7 lines and to their ends.
    assert gone == {0: set(), 1: set(), 2: set(), 62: {11, 12, 13}}
    told = {r["doc_id"]: r["run_lines"] for r in D.dedup_lines(df, min_words=22).collect()}
    assert [told[n] for n in (10, 11, 12, 13)] == [0, 11, 12, 13]


def test_odd_documents_and_an_empty_table(spark, odd, none):
    got = D.dedup_lines(odd)
    assert Counter(got.columns) == Counter([*odd.columns, "n_removed", "run_lines"])
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = brute_force(rows, D.MIN_WORDS)
    told = got.collect()
    assert len(told) == len(rows)
    assert Counter((r["doc_id"], r["text"]) for r in told) == Counter((i, want[i, t][0] if t is not None else None) for i, t in rows)
    assert D.dedup_lines(none).count() == 0


def test_columns_named_as_the_operator_s_own_stay(spark):
    df = spark.createDataFrame([(1, "a line of text, again", "x", "y", "z"), (2, "a line of text, again\nown", "x", "y", "z")], "doc_id BIGINT, text STRING, _doc STRING, _row STRING, _removed STRING")
    got = {r["doc_id"]: r for r in D.dedup_lines(df).collect()}
    assert (got[1]["text"], got[2]["text"]) == ("a line of text, again", "own")
    assert all((r["_doc"], r["_row"], r["_removed"]) == ("x", "y", "z") for r in got.values())


def test_repeated_rows_take_part_once(spark):
    long = "\n".join(f"line {k} of a hundred" for k in range(100))
    loose = "\n".join(f"line {k} without an id" for k in range(40))
    rows = [(1, long), (1, long), (2, "own\n" + long)] + [(None, loose)] * 1000
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    places = D.lines(df.selectExpr("coalesce(doc_id, -1) AS doc", "xxhash64(text) AS row", "text"))
    # Only what another place repeats: neither the own line nor those of equal rows.
    assert [level.count() for level in D.intervals(places)] == [200, 198, 194, 186, 170, 138, 74]
    got = Counter((r["doc_id"], r["text"], r["n_removed"], r["run_lines"]) for r in D.dedup_lines(df).collect())
    assert got == {(1, long, 0, 0): 2, (2, "own", 100, 100): 1, (None, loose, 0, 0): 1000}


def test_the_pipeline_counts_words_and_copies_of_single_lines(spark):
    import corpus_pipeline as P

    # Four words; three words in more than 20 copies, and in fewer; no letter.
    tails = lambda i: ["Released under MIT terms.", "All rights reserved."] + ["See it below."] * (i < 20) + ["}"]
    rows = [(i, "\n".join(x for k, t in enumerate(tails(i)) for x in (f"own {i} {k}", t)) + f"\nown {i}", "en", "a", 0) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").repartition(4)
    for r in P.remove_repeated_lines(spark, docs, "").collect():
        mine = dict((i, t) for i, t, *_ in rows)[r["doc_id"]].split("\n")
        gone = set() if r["doc_id"] == 0 else {"Released under MIT terms.", "All rights reserved."}
        assert r["text"].split("\n") == [x for x in mine if x not in gone]


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame(corpus(6, 10), "doc_id BIGINT, text STRING")
    text = D.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


def test_no_join_of_places_is_a_broadcast(spark):
    docs = spark.createDataFrame([(i, "one two three four five\nsix seven eight nine ten\nonly " + str(i)) for i in range(4)], "doc_id BIGINT, text STRING")
    found = D.dedup_lines(docs, max_copies=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert sorted(r["n_removed"] for r in found.collect()) == [0, 2, 2, 2]
