"""Targets against resharing by hand, rates against a plain solver, caps and reruns."""

import math
import random
import re
from collections import defaultdict

import pytest

from tidemirror.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, mix):
    """Shares of all words by weight; what capped sources leave is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    left, open_, out = mix.share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * left / total > mix.cap * sizes[s]}
        if not over:
            return out | {s: weight[s] * left / total for s in open_}
        for s in over:
            out[s] = float(mix.cap * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def check(spark, rows, got, mix=M.Mix()):
    size = lambda t: len(WORD.findall(t or ""))
    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
        biggest[source] = max(biggest[source], size(text))
    want = targets(sizes, mix)
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i, text, source in rows:
        r = by[i]
        assert r["size"] == size(text) and r["source_size"] == sizes[source]
        assert math.isclose(r["target"], want[source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r["taken"] <= mix.cap * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    for source, target in want.items():
        # Whole documents can miss by half the smallest step at most; the adjustment leaves far less.
        assert abs(taken[source] - target) <= max(0.01 * target, 0.5 * biggest[source]), source


def documents(seed, n=400):
    draw = random.Random(seed)
    sources = ["b", "a", "é", "z", "B", None, "~"]
    return [(i, " ".join(["w"] * int(draw.lognormvariate(3, 1))), draw.choices(sources, [40, 5, 5, 20, 5, 10, 2])[0]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")


def test_targets_caps_and_reruns(spark):
    rows = documents(1)
    got = M.mix_sources(frame(spark, rows).repartition(4)).collect()
    check(spark, rows, got)
    again = M.mix_sources(frame(spark, rows[::-1]).repartition(7)).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in got}


def test_a_hot_source_of_equal_documents(spark):
    rows = [(i, "one two three", "hot") for i in range(500)] + [(1000 + i, "x " * (i + 1), "cold") for i in range(30)]
    check(spark, rows, M.mix_sources(frame(spark, rows), mix=M.Mix(block_rows=7)).collect(), M.Mix())


def test_rates_solve_the_dual(spark):
    """Within a source, rates are the capped exponential of the size that meets the target."""
    rows = [(i, "w " * (1 + i % 40), "a" if i % 3 else "b") for i in range(600)]
    df = frame(spark, rows)
    cells = M.sizes(df, "doc_id", "source", "text").groupBy("source", "size").count().withColumnRenamed("count", "n")
    sizes = {s: sum(1 + i % 40 for i, _, t in rows if t == s) for s in "ab"}
    goals = {"a": 1.3 * sizes["a"], "b": 0.4 * sizes["b"]}
    wanted = spark.createDataFrame([("s" + s, sizes[s], goals[s]) for s in "ab"], "source STRING, source_size BIGINT, target DOUBLE")
    for r in M.tilts(cells, wanted, M.Mix()).collect():
        own = [1 + i % 40 for i, _, t in rows if "s" + t == r["source"]]
        words = sum(x * min(2, math.exp(r["tilt"] * x / r["mean"])) for x in own)
        assert math.isclose(words, goals[r["source"][1:]], rel_tol=1e-6)


def test_a_source_at_its_cap_takes_no_rounds(spark, monkeypatch):
    """Its rates are the cap from the start; the rounds, and with them the driver's plans and jobs, are those of the others."""
    rows = [(i, "w " * (1 + i % 300), "a" if i < 300 else "b") for i in range(600)]
    cells = M.sizes(frame(spark, rows), "doc_id", "source", "text").groupBy("source", "size").count().withColumnRenamed("count", "n")
    size = sum(range(1, 301))
    wanted = spark.createDataFrame([("sa", size, 2.0 * size), ("sb", size, 1.3 * size)], "source STRING, source_size BIGINT, target DOUBLE")
    calls = []
    monkeypatch.setattr(M, "checkpointed", lambda spark, df, kept=M.checkpointed: calls.append(1) or kept(spark, df))
    got = {r["source"]: r for r in M.tilts(cells, wanted, M.Mix()).collect()}
    rate = lambda s, x: min(2, math.exp(got[s]["tilt"] * x / got[s]["mean"]))
    assert all(math.isclose(rate("sa", x), 2, rel_tol=1e-9) for x in range(1, 301))
    assert math.isclose(sum(x * rate("sb", x) for x in range(1, 301)), 1.3 * size, rel_tol=1e-6)
    assert len(calls) <= 10


def test_odd_documents_and_an_empty_table(spark, odd, none):
    got = M.mix_sources(odd)
    assert got.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["copies"] for r in rows if r["size"] == 0} == {1}
    assert M.mix_sources(none).count() == 0
    blank = frame(spark, [(1, None, "a"), (2, " ", None)])
    assert [(r["target"], r["taken"]) for r in M.mix_sources(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_no_python_on_the_main_path(spark):
    text = M.mix_sources(frame(spark, documents(2, 40)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


@pytest.mark.parametrize("mix", [M.Mix(weights=[1], share=0.3), M.Mix(weights=[1, 100], share=1.9)])
def test_other_mixes(spark, mix):
    rows = documents(3, 200)
    check(spark, rows, M.mix_sources(frame(spark, rows), mix=mix).collect(), mix)
