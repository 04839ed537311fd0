"""Streaming forms; over the whole input they give what the batch forms give."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tidemirror.catalog import intake, merging
from tidemirror.catalog.reading import _NATION_PAGES, _nation_pages
from tidemirror.catalog.registry import CHANGED_SINCE, ORACLES, land, query, table
from tidemirror.session import shared_dir
from tidemirror.sources import pages as P
from tidemirror.streaming.page_stream import PageGate, page_stream
from tidemirror.streaming.ratelimit_stream import rate_limit_stream as limited
from tidemirror.streaming.upsert_stream import upsert_stream
from tidemirror.warehouse import Warehouse


def _file_stream(spark, sf, name):
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query(ORACLES["rate_limit_batch"])
def rate_limit_stream(spark, sf):
    root = f"{shared_dir(spark)}/rate-limit-{uuid4().hex}"
    events = _file_stream(spark, sf, "events").select("user_id", "ts", "event_id")
    limited(
        events, "user_id", "ts", "event_id", root=root, limit=intake.LIMIT, window_seconds=intake.WINDOW_SECONDS
    ).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch")


@query(ORACLES["rate_limit_batch"])
def rate_limit_stream_restarted(spark, sf):
    """Events that arrive in three parts; windows that a part leaves open are carried into the next run."""
    root = f"{shared_dir(spark)}/rate-limit-{uuid4().hex}"
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    ends = ["1970-01-01", "2024-01-10 07:00:30", "2024-01-20 12:30:00", "9999-12-31"]
    for begin, end in zip(ends, ends[1:], strict=False):
        at = F.col("ts")
        part = events.filter((at >= F.lit(begin).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))
        part.write.mode("append").parquet(f"{root}/in")
        limited(
            spark.readStream.schema(events.schema).parquet(f"{root}/in"),
            "user_id", "ts", "event_id", root=root, limit=intake.LIMIT, window_seconds=intake.WINDOW_SECONDS,
        ).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch")


@query(f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM ({ORACLES["upsert_merge"]})
""")
def stream_upsert(spark, sf):
    """Changed orders as a file stream, merged into the published table."""
    mark = uuid4().hex
    house = Warehouse(spark, f"{shared_dir(spark)}/stream-upsert-{mark}", f"stream_{mark}")
    house.replace(merging.target(spark, sf), "orders", "o_orderkey")

    def changed(rows):
        recent = rows.filter(F.col("o_orderdate") >= F.lit(CHANGED_SINCE).cast("timestamp_ntz"))
        return merging.as_batch(recent)

    upsert_stream(
        _file_stream(spark, sf, "orders"),
        house,
        "orders",
        key="o_orderkey",
        order=["o_orderdate", "o_totalprice"],
        checkpoint=f"{house.root}/checkpoint",
        prepare=changed,
    ).awaitTermination()
    return house.read("orders")


def _arriving(spark, pages, root, parts=4):
    """Landed pages as a stream of files that hold a mixture of pages, one file in a micro-batch."""
    mixed = pages.select("entity", "view_id", "page", "body").repartition(parts, F.xxhash64("view_id", "page"))
    mixed.write.parquet(f"{root}/landing")
    return spark.readStream.schema(P.PAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")


def _contact_stream(spark, sf):
    """Contacts of all nations, pages in any order, up to the page that failed; the gate and the root of the records."""
    root = f"{shared_dir(spark)}/contact-stream-{uuid4().hex}"
    gate = PageGate(f"{root}/gate", "contacts")
    record = "STRUCT<id: BIGINT, display_name: STRING, balance: DOUBLE>"

    def write(pages, batch_id):
        rows = pages.select(*P.VIEW, "page", F.posexplode(F.from_json("body", f"STRUCT<contacts: ARRAY<{record}>>")["contacts"]).alias("pos", "rec"))
        rows.select(*P.VIEW, "page", "pos", "rec.*").write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    page_stream(_arriving(spark, _nation_pages(spark, sf), root), gate, write, f"{root}/checkpoint").awaitTermination()
    return gate, root


_RUNS = f"""
    WITH {_NATION_PAGES},
    n AS (SELECT view_id, page, ok, count(*) FILTER (ok) OVER (PARTITION BY view_id ORDER BY page) AS usable FROM p)
"""


@query(f"""
    {_RUNS}
    SELECT 'contacts' AS entity, view_id, page, row_number() OVER (PARTITION BY view_id, page ORDER BY c_custkey) - 1 AS pos,
           c_custkey AS id, c_name AS display_name, c_acctbal AS balance
    FROM customer JOIN n ON view_id = c_nationkey AND page = c_custkey // 100 + 1 WHERE ok AND usable = page
""")
def stream_pages(spark, sf):
    """The records a batch load of the same pages reads."""
    _, root = _contact_stream(spark, sf)
    return spark.read.parquet(f"{root}/out").drop("batch")


@query(f"""
    {_RUNS}
    SELECT 'contacts' AS entity, view_id, CAST(count(*) FILTER (ok AND usable = page) AS INTEGER) AS run_end,
           CAST(any_value(expected) AS INTEGER) AS end_page, any_value(is_complete) AS is_complete
    FROM n JOIN c USING (view_id) GROUP BY view_id
""")
def stream_page_state(spark, sf):
    """How far each view's scan has come when the stream ends. A view without a usable first page has no end yet."""
    gate, _ = _contact_stream(spark, sf)
    return gate.state(spark)


@query(ORACLES["stream_upsert"])
def stream_upsert_pages(spark, sf):
    """Changed orders as landed pages of three views, out of order, merged into the published table as their runs close."""
    mark = uuid4().hex
    house = Warehouse(spark, f"{shared_dir(spark)}/stream-pages-{mark}", f"stream_{mark}")
    house.replace(merging.target(spark, sf), "orders", "o_orderkey")
    orders = table(spark, sf, "orders")
    changed = merging.as_batch(orders.filter(F.col("o_orderdate") >= F.lit(CHANGED_SINCE).cast("timestamp_ntz")))
    record = F.struct(*changed.columns)
    pages = land(changed, "deals", "deals", "o_orderkey", record, F.col("o_orderkey") % 3, dense=True)
    kind = changed.schema.simpleString()

    def rows(ready):
        return ready.select(F.explode(F.from_json("body", f"STRUCT<deals: ARRAY<{kind}>>")["deals"]).alias("rec")).select("rec.*")

    upsert_stream(
        _arriving(spark, pages, house.root),
        house,
        "orders",
        key="o_orderkey",
        order=["o_orderdate", "o_totalprice"],
        checkpoint=f"{house.root}/checkpoint",
        prepare=rows,
        release=PageGate(f"{house.root}/gate", "deals"),
    ).awaitTermination()
    return house.read("orders")
