"""The query catalogue: each query next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemirror.session import shared_dir
from tidemirror.sources.pages import landed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The source changed since the first date; the warehouse was last loaded at the second.
# Rows between the two are updates, later ones inserts, earlier ones stay.
CHANGED_SINCE = "1999-01-01"
LOADED_UNTIL = "1999-07-01"
RUN_TS = "2024-02-01 02:00:00"
FIRST_TS = "2024-01-01 02:00:00"

PAGE_SIZE = 100


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def land(
    rows: DataFrame,
    entity: str,
    record_key: str,
    key: str,
    record: Column,
    view: Column | int | None = None,
    empty_end: bool = False,
    single: bool = False,
    wrap: Callable[[Column], Column] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Rows written as page files and read back, at most 100 records of a unique key range per page.

    A null record takes its place but is not served. ``empty_end`` adds the page
    without records that ends a scan whose pages do not say how many there are.
    ``single`` makes every page the only one of a view of its own; ``wrap`` turns the
    records of a page into what the page lists. ``dense`` numbers a view's pages without
    gaps, as a source does that serves changed rows only.
    """
    spark = rows.sparkSession
    several = isinstance(view, Column)
    number = F.expr(f"cast({key} div {PAGE_SIZE} + 1 as int)")
    placed = rows.select(
        (number if single else view if several else F.lit(view)).cast("bigint").alias("view_id"),
        (F.lit(1) if single else number).alias("page"),
        F.struct(F.col(key).alias("_key"), record.alias("_rec")).alias("_one"),
    )
    if dense:
        # One row per page.
        place = F.row_number().over(Window.partitionBy("_view").orderBy("_old"))
        heads = placed.select(F.col("view_id").alias("_view"), F.col("page").alias("_old")).distinct().withColumn("_place", place)
        same = F.col("view_id").eqNullSafe(F.col("_view")) & (F.col("page") == F.col("_old"))
        placed = placed.join(heads, same).select("view_id", F.col("_place").alias("page"), "_one")
    by_key = lambda x, y: F.when(x["_key"] < y["_key"], -1).when(x["_key"] > y["_key"], 1).otherwise(0)
    paged = placed.groupBy("view_id", "page").agg(F.array_sort(F.collect_list("_one"), by_key).alias("_all"))
    if several:
        # One row per view: a handful of views is what a source has.
        totals = placed.groupBy("view_id").agg(F.max("page").alias("total_pages"))
        paged = paged.join(F.broadcast(totals), "view_id")
    else:
        paged = paged.withColumn("total_pages", placed.select(F.max("page")).scalar())
    records = F.filter(F.transform("_all", lambda one: one["_rec"]), lambda rec: rec.isNotNull())
    records = wrap(records) if wrap else records
    body = F.to_json(F.struct(records.alias(record_key), F.struct("total_pages").alias("meta")))
    pages = paged.select(F.lit(entity).alias("entity"), "view_id", "page", body.alias("body"))
    if empty_end:
        none = F.lit(f'{{"{record_key}":[]}}').alias("body")
        last = placed.agg((F.max("page") + 1).alias("page"))
        pages = pages.unionByName(last.select(F.lit(entity).alias("entity"), F.lit(view).cast("bigint").alias("view_id"), "page", none))
    path = f"{shared_dir(spark)}/pages-{uuid4().hex}"
    # Bodies are long: sizes are looked at after a few rows instead of a hundred, and a file is read by several tasks.
    pages.write.options(**{"parquet.page.size.row.check.min": 2, "parquet.block.size": 16 << 20}).parquet(path)
    return landed(spark, path, "parquet")
