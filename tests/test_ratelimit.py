"""The rate limit against a plain loop, and on a stream."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from tidemirror.operators import ratelimit
from tidemirror.operators.ratelimit import open_windows, rate_limit, successors
from tidemirror.streaming.ratelimit_stream import rate_limit_stream

START = datetime(2024, 1, 1)
SCHEMA = "id BIGINT, who STRING, ts TIMESTAMP_NTZ"


def brute_force(events, limit, width):
    state, out = {}, {}
    for i, who, ts in sorted(events, key=lambda e: (e[2], e[0])):
        begun, used = state.get(who, (None, 0))
        if begun is None or (ts - begun).total_seconds() >= width:
            begun, used = ts, 0
        allowed = used < limit
        used += allowed
        state[who] = (begun, used)
        out[i] = (allowed, limit - used)
    return out


def at(*seconds, who="k"):
    return [(i, who, START + timedelta(seconds=s)) for i, s in enumerate(seconds)]


def run(spark, events, **options):
    df = spark.createDataFrame(events, SCHEMA).repartition(3)
    got = rate_limit(df, "who", "ts", "id", **options).collect()
    assert len(got) == len(events)
    return {r["id"]: (r["allowed"], r["remaining"]) for r in got}


def test_anchored_window_resets_exactly_at_its_length(spark):
    got = run(spark, at(0, 1, 2, 59, 60, 61, 62), limit=2, window_seconds=60)
    assert [got[i][0] for i in range(7)] == [True, True, False, False, True, True, False]
    assert [got[i][1] for i in range(7)] == [1, 0, 0, 0, 1, 0, 0]


def test_eleventh_request_is_blocked(spark):
    got = run(spark, at(*range(11)))
    assert [got[i][0] for i in range(11)] == [True] * 10 + [False]


def test_keys_do_not_share_windows(spark):
    events = at(0, 1) + [(10 + i, w, t) for i, w, t in at(0, 1, who="other")]
    got = run(spark, events, limit=1)
    assert [got[i][0] for i in (0, 1, 10, 11)] == [True, False, True, False]


@pytest.mark.parametrize("limit, seed", [(1, 1), (2, 2), (3, 3)])
def test_random_events_agree_with_the_loop(spark, limit, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(80):
        seconds = draw.choice([draw.randrange(400), draw.uniform(0, 400), 100 * draw.randrange(5)])
        rows.append((i, draw.choice("aab"), START + timedelta(microseconds=int(seconds * 1_000_000))))
    assert run(spark, rows, limit=limit, window_seconds=40) == brute_force(rows, limit, 40)


def test_dense_hot_key(spark):
    """The hot key fills every window and spreads over all partitions of the sort."""
    hot = [(i, "hot", START + timedelta(milliseconds=137 * i)) for i in range(6000)]
    cold = [(10_000 + i, f"c{i % 7}", START + timedelta(seconds=11 * i)) for i in range(70)]
    got = run(spark, hot + cold, limit=3, window_seconds=2)
    assert got == brute_force(hot + cold, 3, 2)


def test_rounds_grow_with_the_digits_of_the_windows(spark):
    """Ten times the windows add a few jobs, not ten times as many."""

    def jobs(n):
        spark.sparkContext.setJobGroup(f"rounds-{n}", "count")
        run(spark, at(*range(n)), limit=1, window_seconds=1)
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{n}")
        spark.sparkContext.setJobGroup("other", "")
        return len(found)

    few, many = jobs(30), jobs(300)
    assert many <= 2 * few


def test_successor_is_the_first_time_one_window_later(spark):
    times = [0, 1, 5, 9, 10, 11, 30]
    df = spark.createDataFrame([("k", t) for t in times] + [("j", 12)], "who STRING, _t BIGINT")
    got = {(r["who"], r["_t"]): r["_next"] for r in successors(df, "who", 10).collect()}
    assert got == {("k", t): min(x for x in times if x >= t + 10) for t in times if t + 10 <= 30}


def test_a_missing_key_is_a_key_of_its_own(spark):
    events = at(0, 1, 30, 61, 125, who=None) + [(10 + i, w, t) for i, w, t in at(0, 1, 2)]
    assert run(spark, events, limit=1, window_seconds=10) == brute_force(events, 1, 10)


def test_carried_windows_go_on_and_end(spark):
    first, second = at(0, 3, 4), [(10 + i, w, t) for i, w, t in at(5, 9, 10, 11)]
    df = [spark.createDataFrame(e, SCHEMA) for e in (first, second)]
    carried = open_windows(df[0], "who", "ts", limit=4, window_seconds=10)
    assert [tuple(r)[2] for r in carried.collect()] == [3]
    got = rate_limit(df[1], "who", "ts", "id", limit=4, window_seconds=10, carried=carried).collect()
    want = brute_force(first + second, 4, 10)
    assert {r["id"]: (r["allowed"], r["remaining"]) for r in got} == {i: want[i] for i, _, _ in second}
    late = spark.createDataFrame([(99, "z", START + timedelta(hours=1))], SCHEMA)
    assert [r["who"] for r in open_windows(late, "who", "ts", window_seconds=10, carried=carried).collect()] == ["z"]


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rate_limit(empty, "who", "ts", "id").count() == 0


@pytest.mark.parametrize("files", [1, 4])
def test_stream_agrees_with_batch(spark, tmp_path, files):
    events = [(i, f"k{i % 5}", START + timedelta(seconds=3 * i)) for i in range(200)]
    per_file = defaultdict(list)
    for e in events:
        per_file[e[0] * files // len(events)].append(e)
    for n, part in sorted(per_file.items()):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rate_limit_stream(stream, "who", "ts", "id", root=str(tmp_path), limit=2, window_seconds=60).awaitTermination()
    got = {r["id"]: (r["allowed"], r["remaining"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == brute_force(events, 2, 60)


def hot_events(n, step_ms):
    return [(i, "hot", START + timedelta(milliseconds=step_ms * i)) for i in range(n)]


def test_a_row_is_looked_at_once_for_its_successor(spark):
    """No frame is gone through anew for every row; a hot key's rows would be passed as often as they are many."""
    df = spark.createDataFrame([("k", t) for t in range(10)], "who STRING, _t BIGINT")
    assert "unboundedfollowing" not in successors(df, "who", 3)._jdf.queryExecution().optimizedPlan().toString()


def test_rounds_join_ways_into_blocks_and_not_every_time(spark, monkeypatch):
    """What the rounds keep does not grow with the times inside the blocks."""
    kept = []

    def counted(session, df):
        out = checkpointed(session, df)
        kept.append(out.count())
        return out

    checkpointed = ratelimit.checkpointed
    monkeypatch.setattr(ratelimit, "checkpointed", counted)
    events = hot_events(6000, 137)
    assert run(spark, events, limit=3, window_seconds=2) == brute_force(events, 3, 2)
    # An event's time and the end of its window are sorted once.
    assert sum(kept) < 3 * len(events)


@pytest.mark.parametrize("block", [1, 4, 64])
@pytest.mark.parametrize("step_ms", [100, 900, 7000])
def test_chains_through_many_blocks_agree_with_the_loop(spark, monkeypatch, block, step_ms):
    """Windows inside a block, as long as one, and over several."""
    monkeypatch.setattr(ratelimit, "BLOCK", block)
    draw = random.Random(block)
    hot = [(i, draw.choice(["hot", "hot", "warm", None]), ts + timedelta(microseconds=draw.randrange(2_000_000))) for i, _, ts in hot_events(300, step_ms)]
    assert run(spark, hot, limit=2, window_seconds=6) == brute_force(hot, 2, 6)
