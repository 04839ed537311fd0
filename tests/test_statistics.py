"""Sketches of runs, united, tell what one sketch of all rows tells."""

import pytest

from tidemirror.operators import statistics as S

SCHEMA = "entity STRING, run INT, id BIGINT, size DOUBLE"


def test_runs_add_up_and_a_repeated_run_counts_once(spark):
    rows = [("a", i % 5, i % 800, float(i)) for i in range(2000)] + [("b", 1, None, None), ("b", 2, None, 3.0), ("b", 2, 7, None)] + [("c", 1, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = S.scan_statistics(df, ["entity", "run"], "id", "size")
    again = S.scan_statistics(df.filter("run = 2"), ["entity", "run"], "id", "size")
    united = S.united(S.put_statistics(kept, again, ["entity", "run"]), ["entity"])
    got = {r["entity"]: r for r in S.told(united).collect()}
    assert (got["a"]["rows"], got["b"]["rows"], got["c"]["rows"]) == (2000, 3, 1)
    assert got["a"]["distinct_ids"] == pytest.approx(800, rel=0.03)
    assert got["a"]["size_p50"] == pytest.approx(1000, abs=60) and got["a"]["size_p95"] == pytest.approx(1900, abs=60)
    assert (got["b"]["distinct_ids"], got["b"]["size_p50"]) == (1, 3.0)
    assert (got["c"]["distinct_ids"], got["c"]["size_p50"]) == (0, None)
    # United again, the sketches stay sketches; quantiles are drawn by chance within their error.
    twice = {r["entity"]: r for r in S.told(S.united(united, ["entity"])).collect()}
    assert twice["a"]["distinct_ids"] == got["a"]["distinct_ids"] and twice["a"]["size_p50"] == pytest.approx(1000, abs=60)


def test_an_empty_table_has_no_statistics(spark):
    empty = S.scan_statistics(spark.createDataFrame([], SCHEMA), ["entity", "run"], "id", "size")
    assert S.told(S.united(empty, ["entity"])).count() == 0
