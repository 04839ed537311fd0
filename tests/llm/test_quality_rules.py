"""The ledger against a plain count, policies and ablations."""

import collections
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemirror.llm import quality_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    found = collections.Counter(windows)
    covered = {i for k, w in enumerate(windows) if found[w] > 1 for i in range(k, k + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text)),
    }


TEXTS = st.lists(st.one_of(st.none(), st.text("ab é\n\r#A ", max_size=60)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_measures_agree_with_a_plain_count(texts):
    got = R.measure(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute_force(text), text


def test_odd_documents_and_an_empty_table(odd, none):
    rows = R.ledger(odd)
    assert rows.columns == ["doc_id", *R.MEASURES, "failed"]
    got = collections.Counter((r["doc_id"], *(r[m] for m in R.MEASURES)) for r in rows.collect())
    assert got == collections.Counter((r["doc_id"], *brute_force(r["text"]).values()) for r in odd.collect())
    assert R.ledger(none).count() == 0
    assert [r["documents"] for r in R.ablations(R.ledger(none), R.POLICIES["v1"]).collect()] == [0] * 5


def test_bits_policies_and_ablations(spark, sf):
    rows = R.ledger(spark.read.parquet(f"{sf}/documents.parquet")).cache()
    all_rows = rows.collect()
    for r in all_rows:
        want = 0
        want |= (r["n_words"] < 10) << 0
        want |= (100 * r["n_repeat_words"] > 20 * r["n_words"]) << 1
        want |= (100 * r["n_symbols"] > 10 * r["n_words"]) << 2
        want |= (100 * r["n_dup_lines"] > 30 * r["n_lines"]) << 3
        want |= (100 * r["n_upper"] > 40 * r["n_letters"]) << 4
        want |= (r["word_chars"] < 2 * r["n_words"] or r["word_chars"] > 15 * r["n_words"]) << 5
        assert r["failed"] == want
    for policy in R.POLICIES.values():
        kept = rows.filter(R.passes(policy)).count()
        assert kept == sum(not r["failed"] & policy for r in all_rows)
        told = {r["rule"]: (r["fails"], r["fails_alone"]) for r in R.ablations(rows, policy).collect()}
        for rule in R.RULES:
            if policy >> rule.bit & 1:
                bit = 1 << rule.bit
                fails = sum(bool(r["failed"] & bit) for r in all_rows)
                # Leaving the rule out keeps exactly the documents it fails alone.
                without = sum(not r["failed"] & (policy & ~bit) for r in all_rows)
                assert told[rule.name] == (fails, without - kept)
    rows.unpersist()


def test_query_has_the_contract_s_columns(spark, sf):
    from tidemirror.llm.queries import QUERIES

    rows = QUERIES["op9_quality_rules"](spark, sf).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_force(docs[r["doc_id"]])
        base = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == tuple(want.values())[:5]
        assert r["base_failed"] == base and not (r["kept"] and base)
