"""Streaming upsert from landed pages: order of copies, replays, restarts."""

import json
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemirror.functions import quality as Q
from tidemirror.operators.upsert import ACTION, upsert
from tidemirror.plans.entities import REGISTRY
from tidemirror.plans.project import envelope_type, project
from tidemirror.sources.pages import EVERY_PAGE, PAGE_SCHEMA, dedup_views, read_pages
from tidemirror.streaming.upsert_stream import upsert_stream
from tidemirror.warehouse import Layout, Warehouse

SPEC = REGISTRY["products"]
COLUMNS = ["id", "name", "price", "updated_at"]


def land(spark, path, records):
    body = json.dumps({"products": records, "meta": {"total_pages": 1}})
    spark.createDataFrame([("products", None, 1, body)], PAGE_SCHEMA).coalesce(1).write.mode("append").json(path)


def product(i, price, day):
    return {"id": i, "name": f"p{i}", "base_currency_amount": price, "updated_at": f"2024-01-{day:02}T00:00:00Z"}


def rows_of(pages):
    """Landed pages of one micro-batch as product rows."""
    read = read_pages(pages, "products", envelope_type(SPEC), EVERY_PAGE)
    good, _ = Q.split(project(read, SPEC))
    return good.select(*COLUMNS)


@pytest.fixture()
def house(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), f"stream_{uuid4().hex}", Layout(slices=2, buckets=2))
    start = spark.createDataFrame([(1, "p1", 1.0, None), (9, "p9", 9.0, None)], "id BIGINT, name STRING, price DOUBLE, u STRING")
    house.replace(start.select("id", "name", "price", F.col("u").cast("timestamp_ntz").alias("updated_at")), "products", "id")
    return house


def run(spark, house, tmp_path, **options):
    pages = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "pages"))
    query = upsert_stream(
        pages, house, "products", checkpoint=str(tmp_path / "checkpoint"), order=["updated_at"], prepare=rows_of, **options
    )
    query.awaitTermination()
    return {r["id"]: r["price"] for r in house.read("products").collect()}


def files_of(house):
    return {r[0] for r in house.read("products").select("_metadata.file_path").distinct().collect()}


def test_pages_are_merged_file_by_file_and_only_once(spark, house, tmp_path):
    land(spark, str(tmp_path / "pages"), [product(1, 2.0, 3), product(1, 1.5, 2), product(2, 5.0, 2)])
    assert run(spark, house, tmp_path) == {1: 2.0, 2: 5.0, 9: 9.0}
    files = files_of(house)
    assert run(spark, house, tmp_path) == {1: 2.0, 2: 5.0, 9: 9.0}
    assert files_of(house) == files
    land(spark, str(tmp_path / "pages"), [product(2, 6.0, 4), product(3, 7.0, 4)])
    assert run(spark, house, tmp_path) == {1: 2.0, 2: 6.0, 3: 7.0, 9: 9.0}


def test_older_copies_do_not_replace_newer_rows_when_a_version_is_named(spark, house, tmp_path):
    land(spark, str(tmp_path / "pages"), [product(1, 2.0, 9)])
    run(spark, house, tmp_path, version="updated_at")
    land(spark, str(tmp_path / "pages"), [product(1, 1.0, 5)])
    assert run(spark, house, tmp_path, version="updated_at")[1] == 2.0


def test_stream_gives_what_one_batch_gives(spark, house, tmp_path):
    before = house.read("products")
    base = spark.createDataFrame(before.collect(), before.schema)
    sent = [product(i % 4, float(i), 1 + i) for i in range(12)]
    for part in (sent[:5], sent[5:8], sent[8:]):
        land(spark, str(tmp_path / "pages"), part)
    got = run(spark, house, tmp_path, version="updated_at")
    pages = spark.createDataFrame([("products", None, 1, json.dumps({"products": sent}))], PAGE_SCHEMA)
    merged = upsert(base, rows_of(pages), "id", order=["updated_at"]).drop(ACTION)
    assert got == {r["id"]: r["price"] for r in merged.collect()}


def test_a_replayed_micro_batch_is_skipped(spark, house, tmp_path):
    land(spark, str(tmp_path / "pages"), [product(1, 2.0, 3)])
    run(spark, house, tmp_path)
    files = files_of(house)
    # As if the job had died after publishing but before the commit was written.
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    assert run(spark, house, tmp_path)[1] == 2.0
    assert files_of(house) == files


def test_dedup_takes_the_last_place_within_a_batch(spark):
    rows = [(0, 1, 0, 5, "a"), (0, 1, 1, 5, "b")]
    df = spark.createDataFrame(rows, "view_id BIGINT, page INT, pos INT, id BIGINT, v STRING")
    assert dedup_views(df, "id", [0]).first()["v"] == "b"
