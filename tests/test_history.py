"""Histories by intervals against daily copies."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemirror.operators import history as H
from tidemirror.operators.reports import dated

SCHEMA = "id BIGINT, stage STRING"
DAYS = [f"2024-03-{d:02}" for d in range(1, 8)]


def copies(seed):
    draw = random.Random(seed)
    keys = [*range(8), None]
    return {d: sorted({(k, draw.choice(["a", "b", None])) for k in keys if draw.random() < 0.8}, key=str) for d in DAYS}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def kept(history):
    """The history as a table would give it back, so that plans do not grow."""
    return history.sparkSession.createDataFrame(history.collect(), history.schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_days_in_any_order_and_again_give_the_same_history(spark, seed):
    told = copies(seed)
    frame = lambda d: spark.createDataFrame(told[d], SCHEMA).repartition(2)
    nothing = spark.createDataFrame([], SCHEMA)
    every = None
    for d in DAYS:
        every = dated(frame(d), d) if every is None else every.unionByName(dated(frame(d), d))
    want = rows(H.from_daily(every))
    order = DAYS[1:]
    random.Random(seed).shuffle(order)
    history, seen = kept(H.begin_history(frame(DAYS[0]), DAYS[0])), [DAYS[0]]
    # One day is told wrongly first, and another one twice.
    for d in [order[0], order[2], *order, order[1]]:
        told_now = nothing if d == order[2] and d not in seen else frame(d)
        after = [s for s in seen if s > d]
        history = kept(H.put_snapshot(history, told_now, d, min(after, default=None)))
        seen.append(d)
    assert rows(history) == want
    for d in DAYS:
        assert rows(H.snapshot_on(history, d)) == sorted(told[d], key=str)
    again = [(r["id"], r["stage"], str(r["snapshot_date"])) for r in H.daily(history, DAYS).collect()]
    assert sorted(again, key=str) == sorted(((*r, d) for d in DAYS for r in told[d]), key=str)


def test_only_changes_are_stored(spark):
    same = spark.createDataFrame([(i, "a") for i in range(50)], SCHEMA)
    history = H.begin_history(same, DAYS[0])
    for d in DAYS[1:4]:
        history = kept(H.put_snapshot(history, same, d))
    assert history.count() == 50
    changed = same.withColumn("stage", F.when(F.col("id") < 3, "b").otherwise(F.col("stage")))
    history = kept(H.put_snapshot(history, changed, DAYS[4]))
    assert history.count() == 53
    assert rows(H.put_snapshot(history, changed, DAYS[4])) == rows(history)
    assert H.put_snapshot(history, same.limit(0), DAYS[5]).where(F.col("valid_to") == H.OPEN).count() == 0


def test_a_day_is_a_pushed_filter_and_old_rows_are_not_shuffled(spark, tmp_path):
    same = spark.createDataFrame([(1, "a")], SCHEMA)
    H.begin_history(same, DAYS[0]).write.parquet(f"{tmp_path}/history")
    stored = spark.read.parquet(f"{tmp_path}/history")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # The plan's text cuts the list of filters short.
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(valid_from,[-0-9]+\), GreaterThan\(", plan(H.snapshot_on(stored, DAYS[2])))
    merged = plan(H.put_snapshot(stored, same, DAYS[2]))
    # The copy's repeats and the merge; the branch of old rows has a scan and a filter only.
    assert merged.count("Exchange hashpartitioning") == 2, merged


def test_the_next_day_comes_later(spark):
    same = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(ValueError):
        H.put_snapshot(H.begin_history(same, DAYS[0]), same, DAYS[3], DAYS[2])
