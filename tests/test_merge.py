"""Upsert, children, relations, reconcile: rules and invariants."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemirror.operators.reconcile import id_blocks, missing_whole_ids
from tidemirror.operators import reconcile as R
from tidemirror.operators.children import cascade, replace_children, replace_relations
from tidemirror.operators import history
from tidemirror.operators.reports import dated
from tidemirror.operators.upsert import ACTION, action_counts, latest_per_key, surrogate_keys, upsert

ROW = "id BIGINT, name STRING, n INT"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_batch_null_overwrites_and_unchanged_is_an_update(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], ROW)
    batch = spark.createDataFrame([(1, None, 1), (2, "b", 2), (4, "d", 4)], ROW)
    merged = upsert(target, batch)
    assert rows(merged) == Counter(
        [(1, None, 1, "UPDATE"), (2, "b", 2, "UPDATE"), (3, "c", 3, "KEEP"), (4, "d", 4, "INSERT")]
    )
    assert tuple(action_counts(merged).first()) == (1, 2)


def test_second_run_inserts_nothing(spark):
    target = spark.createDataFrame([(1, "a", 1)], ROW)
    batch = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], ROW)
    once = upsert(target, batch).drop(ACTION)
    twice = upsert(once, batch)
    assert action_counts(twice).first()["inserted"] == 0
    assert rows(twice.drop(ACTION)) == rows(once)


def test_duplicate_key_fails_the_job(spark):
    target = spark.createDataFrame([(1, "a", 1)], ROW)
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], ROW)
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, batch).count()
    assert rows(upsert(target, batch, order=["n"])) == Counter([(1, "a", 1, "KEEP"), (2, "y", 2, "INSERT")])


def test_version_keeps_the_newer_row(spark):
    target = spark.createDataFrame([(1, "new", 5), (2, "old", 1)], ROW)
    batch = spark.createDataFrame([(1, "old", 4), (2, "new", 2)], ROW)
    merged = upsert(target, batch, version="n")
    assert rows(merged) == Counter([(1, "new", 5, "KEEP"), (2, "new", 2, "UPDATE")])


PEOPLE = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=PEOPLE, batch=PEOPLE)
def test_merge_agrees_with_a_dict(spark, target, batch):
    old = {r[0]: r for r in target}
    new = {}
    for i, r in enumerate(batch):
        new[r[0]] = (*r, i)
    t = spark.createDataFrame(list(old.values()), ROW)
    b = spark.createDataFrame([(*r, i) for i, r in enumerate(batch)], ROW + ", at INT")
    want = Counter()
    for key in old.keys() | new.keys():
        action = "KEEP" if key not in new else "UPDATE" if key in old else "INSERT"
        want[(*(new[key][:3] if key in new else old[key]), action)] += 1
    t = t.repartition(2)
    got = upsert(t, b, order=["at"])
    assert rows(got.select("id", "name", "n", ACTION)) == want
    stamped = upsert(t, b, order=["at"], run_ts="2024-01-01 00:00:00")
    kept = stamped.filter("_action = 'KEEP'")
    assert kept.filter("etl_updated_at is not null").isEmpty()
    assert stamped.filter("_action <> 'KEEP' and etl_updated_at is null").isEmpty()


def test_columns_the_batch_does_not_have_stay(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROW)
    batch = spark.createDataFrame([(1, "x"), (3, "y")], "id BIGINT, name STRING")
    assert rows(upsert(target, batch)) == Counter([(1, "x", 1, "UPDATE"), (2, "b", 2, "KEEP"), (3, "y", None, "INSERT")])


def test_latest_per_key_with_a_hot_key(spark):
    hot = spark.range(0, 20_000).select(F.lit(1).cast("bigint").alias("id"), F.col("id").alias("v"))
    rest = spark.range(0, 10).select((F.col("id") + 2).alias("id"), F.col("id").alias("v"))
    last = latest_per_key(hot.unionByName(rest), ["id"], ["v"])
    assert last.count() == 11
    assert last.filter("id = 1").first()["v"] == 19_999
    assert "WindowGroupLimit" in last._jdf.queryExecution().toString()


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.lit(7) * F.col("id") % 1000).alias("k"), F.lit("x").alias("v"))
    got = surrogate_keys(df.repartition(5), ["k"], start=50).collect()
    assert sorted(r["id"] for r in got) == list(range(51, 1051))
    assert all(r["id"] == r["k"] + 51 for r in got)


def test_surrogate_keys_without_an_order_do_not_sort(spark):
    df = spark.range(0, 1000).repartition(5)
    assert sorted(r["k"] for r in surrogate_keys(df, None, start=7, column="k").collect()) == list(range(8, 1008))


def test_columns_named_like_helpers_stay(spark):
    names = ["_part", "_row", "_shift", "_rank", "_Island", "_first", "_at", "_next"]
    df = spark.range(20).select("id", *[F.lit(n).alias(n) for n in names])
    want = {(i, *names) for i in range(20)}
    numbered = surrogate_keys(df.repartition(3), ["id"], column="k")
    assert {tuple(r[:-1]) for r in numbered.collect()} == want and numbered.columns == [*df.columns, "k"]
    assert {tuple(r) for r in latest_per_key(df.unionAll(df), ["id"], ["_row"]).collect()} == want
    begun = history.begin_history(df, "2024-01-01")
    assert {tuple(r) for r in history.put_snapshot(begun, df, "2024-01-02").drop(*history.BOUNDS).collect()} == want
    assert history.from_daily(dated(df, "2024-01-01")).drop(*history.BOUNDS).count() == 20


def test_replace_children(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "deal_id BIGINT, v STRING")
    new = spark.createDataFrame([(1, "z"), (4, "y")], "deal_id BIGINT, v STRING")
    assert rows(replace_children(old, new, "deal_id")) == Counter([(1, "z"), (4, "y"), (2, "c"), (3, "d")])
    parents = spark.createDataFrame([(1,), (2,), (4,)], "deal_id BIGINT")
    assert rows(replace_children(old, new, "deal_id", parents=parents)) == Counter([(1, "z"), (4, "y"), (3, "d")])


def test_replace_relations_drops_pairs_of_empty_parents(spark):
    pair = "team_id BIGINT, user_id BIGINT"
    old = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], pair)
    new = spark.createDataFrame([(1, 11), (1, 11)], pair)
    parents = spark.createDataFrame([(1,), (2,)], "team_id BIGINT")
    assert rows(replace_relations(old, new, parents, "team_id")) == Counter([(1, 11), (3, 30)])


def test_reconcile_leaves_only_active_rows_and_their_children(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], ROW)
    lines = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "deal_id BIGINT, line INT")
    active = spark.createDataFrame([(1,), (None,)], "id BIGINT")
    done = R.reconcile(target, active, children={"lines": (lines, "deal_id")})
    assert done.outcome == R.APPLIED
    assert [r["id"] for r in done.kept.collect()] == [1]
    assert done.deleted.filter("id = 2").count() == 1
    assert rows(done.kept_children["lines"]) == Counter([(1, 1)])
    assert done.deleted_children["lines"].count() == 2


@pytest.mark.parametrize(
    "options, outcome",
    [
        ({"failed": 1}, R.LOAD_FAILED),
        ({"complete": False}, R.INCOMPLETE),
        ({"table": "x", "allowed": {"y"}}, R.NOT_ALLOWED),
        ({"empty": True}, R.EMPTY),
        ({"none": True}, R.INCOMPLETE),
    ],
)
def test_guards_delete_nothing(spark, options, outcome):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROW)
    active = spark.createDataFrame([] if options.pop("empty", False) else [(1,)], "id BIGINT")
    if options.pop("none", False):
        active = None
    done = R.reconcile(target, active, **options)
    assert (done.outcome, done.kept.count(), done.deleted.count()) == (outcome, 2, 0)


def test_cascade_splits_all_children(spark):
    lines = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "deal_id BIGINT, line INT")
    kept, gone = cascade(lines, spark.createDataFrame([(2,), (2,)], "id BIGINT"), "deal_id")
    assert rows(kept) == Counter([(1, 1), (3, 1)]) and rows(gone) == Counter([(2, 1)])


def test_id_bitmaps_give_the_missing_ids(spark):
    ids = [1, 2, 3, 7, 100, 32767, 32768, 32769, 40000, 100000, 0, -1, -5, -32768, -40000, 2**40, 7, None]
    known = [2, 100, 32768, -5, 7, 9, -32768, 2**40 + 1, None]
    target, active = (spark.createDataFrame([(i,) for i in x], "id BIGINT") for x in (ids, known))
    got = [r["id"] for r in missing_whole_ids(target, active).collect()]
    assert sorted(got) == sorted({i for i in ids if i is not None} - set(known))
    assert missing_whole_ids(target.limit(0), active).isEmpty()
    assert sorted(r["id"] for r in missing_whole_ids(target, active.limit(0)).collect()) == sorted(set(ids) - {None})


def test_id_bitmaps_shuffle_a_row_per_block(spark):
    many = spark.range(0, 400_000, 1, 4).selectExpr("id div 2 AS id")
    blocks = id_blocks(many)
    assert blocks.count() == 7
    # Partial bitmaps: no task sends more than its blocks.
    text = blocks._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in text
    assert missing_whole_ids(many, spark.range(150_000)).count() == 50_000
