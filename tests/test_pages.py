"""Page scans: stop rules, completeness, sweeps and view order."""

import json

import pytest
from pyspark.sql import functions as F

from tidemirror.sources import nested
from tidemirror.sources import pages as P

RECORD = "STRUCT<id: BIGINT>"


def page(entity, view, number, ids, total=None, body=None):
    if body is None:
        envelope = {entity: [{"id": i} for i in ids]}
        if total is not None:
            envelope["meta"] = {"total_pages": total}
        body = json.dumps(envelope)
    return (entity, view, number, body)


def frame(spark, rows):
    return spark.createDataFrame(rows, P.PAGE_SCHEMA)


def scan(spark, rows, rule, entity="tasks"):
    df = frame(spark, rows)
    ids = sorted(r[0] for r in P.read_pages(df, entity, RECORD, rule).select("rec.id").collect())
    whole = {r["view_id"]: r["is_complete"] for r in P.page_completeness(df, entity, rule).collect()}
    return ids, whole


def test_first_page_tells_the_number_of_pages(spark):
    rows = [page("deals", 1, 1, [1], 2), page("deals", 1, 2, [2], 9), page("deals", 1, 3, [3], 9)]
    assert scan(spark, rows, P.FIRST_PAGE, "deals") == ([1, 2], {1: True})


def test_no_number_means_one_page(spark):
    assert scan(spark, [page("deals", 1, 1, [1]), page("deals", 1, 2, [2])], P.FIRST_PAGE, "deals") == ([1], {1: True})


def test_missing_page_ends_the_scan_and_is_told(spark):
    rows = [page("deals", 1, n, [n], 4) for n in (1, 2, 4)] + [page("deals", 2, 1, [10], 1)]
    assert scan(spark, rows, P.FIRST_PAGE, "deals") == ([1, 2, 10], {1: False, 2: True})


@pytest.mark.parametrize("body", ["{}", "garbage", "", None])
def test_unreadable_page_counts_as_failed(spark, body):
    rows = [page("deals", 1, 1, [1], 2), ("deals", 1, 2, body)]
    assert scan(spark, rows, P.FIRST_PAGE, "deals") == ([1], {1: False})


def test_missing_first_page_reads_nothing(spark):
    assert scan(spark, [page("deals", 1, 2, [2], 2)], P.FIRST_PAGE, "deals") == ([], {1: False})


def test_every_page_repeats_the_number(spark):
    rows = [page("products", None, 1, [1], 3), page("products", None, 2, [2], 2), page("products", None, 3, [3], 3)]
    assert scan(spark, rows, P.EVERY_PAGE, "products") == ([1, 2], {0: True})


def test_empty_page_ends_the_scan(spark):
    rows = [page("tasks", None, 1, [1]), page("tasks", None, 2, []), page("tasks", None, 3, [3])]
    assert scan(spark, rows, P.UNTIL_EMPTY) == ([1], {0: True})


def test_scan_without_its_empty_page_is_not_proven_whole(spark):
    assert scan(spark, [page("tasks", None, 1, [1]), page("tasks", None, 2, [2])], P.UNTIL_EMPTY) == ([1, 2], {0: False})


def test_sweep_is_all_or_nothing(spark):
    whole = [page("deals", 1, 1, [1, 2, 0], 1), page("deals", 2, 1, [2, 3, None], 1)]
    sweep = lambda rows, views: sorted(r["id"] for r in P.active_ids(frame(spark, rows), "deals", P.FIRST_PAGE, views, True).collect())
    assert sweep(whole, [1, 2]) == [1, 2, 3]
    assert sweep(whole, [1]) == [1, 2]
    assert sweep(whole, [1, 2, 3]) == []
    assert sweep(whole, None) == []
    assert sweep([*whole, page("deals", 2, 2, [], body="{}")], [1, 2]) == [1, 2, 3]
    assert sweep([page("deals", 1, 1, [1], 2), whole[1]], [1, 2]) == []


def test_copy_of_the_view_read_last_wins(spark):
    rows = [(5, 2, 0, 1, "view 5"), (9, 1, 0, 1, "view 9"), (5, 1, 3, 2, "first"), (5, 1, 4, 2, "second")]
    df = spark.createDataFrame(rows, "view_id BIGINT, page INT, pos INT, id BIGINT, v STRING")
    assert {r["id"]: r["v"] for r in P.dedup_views(df, "id", [5, 9]).collect()} == {1: "view 9", 2: "second"}
    assert {r["id"]: r["v"] for r in P.dedup_views(df, "id", [9, 5]).collect()} == {1: "view 5", 2: "second"}


def test_since_is_strict(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:01",)], "t STRING").select(
        F.col("t").cast("timestamp_ntz")
    )
    assert P.since(df, "t", "2024-01-01 00:00:00").count() == 1
    assert P.since(df, "t", None).count() == 2


def test_landed_reads_json_lines(spark, tmp_path):
    rows = [page("tasks", None, 1, [1]), page("tasks", None, 2, [])]
    frame(spark, rows).write.json(str(tmp_path / "pages"))
    read = P.read_pages(P.landed(spark, str(tmp_path / "pages")), "tasks", RECORD, P.UNTIL_EMPTY)
    assert [r[0] for r in read.select("rec.id").collect()] == [1]


def test_option_list_takes_the_first_match(spark):
    body = '{"fields":[{"name":"a","choices":[]},{"name":"f","choices":[{"id":1}]},{"name":"f","choices":[{"id":2}]}]}'
    df = spark.createDataFrame([(body,), ("{}",)], "b STRING")
    df = df.select(F.from_json("b", "fields ARRAY<STRUCT<name: STRING, choices: ARRAY<STRUCT<id: BIGINT>>>>").alias("r"))
    assert [r["id"] for r in nested.option_list(df.select("r.*"), "fields", "f").collect()] == [1]
    assert nested.option_list(df.select("r.*"), "fields", "missing").count() == 0
