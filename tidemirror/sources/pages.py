"""Landed pages: one row per page, ``(entity, view_id, page, body)``.

A body is the JSON envelope of one page: the records under the entity's key,
and optionally ``meta.total_pages``. Where a scan ends is decided per view by the
entity's scan rule:

- ``FIRST_PAGE``: page 1 tells the number of pages (1 when it does not say)
- ``EVERY_PAGE``: each page repeats the number; the first page at or past it is last
- ``UNTIL_EMPTY``: the first page without records is last
- ``SINGLE``: there is only page 1

An empty page always ends a scan, and so does a page that is missing or unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemirror.operators.upsert import latest_per_key

FIRST_PAGE = "first_page"
EVERY_PAGE = "every_page"
UNTIL_EMPTY = "until_empty"
SINGLE = "single"

PAGE_SCHEMA = "entity STRING, view_id BIGINT, page INT, body STRING"
VIEW = ["entity", "view_id"]

# Counting records needs no more of them than this.
_HEAD = "STRUCT<id: STRING>"


def landed(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Page files (JSON lines or Parquet), laid out or not by ``entity=/view_id=``."""
    return spark.read.schema(PAGE_SCHEMA).format(file_format).load(path)


def page_heads(pages: DataFrame, record_key: str, *more: str) -> DataFrame:
    """Per landed page: whether it is usable, how many records it holds, how many pages there are.

    A body that is no JSON object, or an empty object, counts as a failed page. Records
    are read with a single field, which is all that counting them needs. Columns named in
    ``more`` stay.
    """
    envelope = f"STRUCT<`{record_key}`: ARRAY<{_HEAD}>, meta: STRUCT<total_pages: INT>, _corrupt: STRING>"
    read = pages.withColumn("_env", F.from_json("body", envelope, {"columnNameOfCorruptRecord": "_corrupt"}))
    filled = F.col("body").rlike(r'^\s*\{\s*"') & F.col("_env._corrupt").isNull()
    return read.select(
        *_view(),
        "page",
        F.coalesce(filled, F.lit(False)).alias("ok"),
        F.col("_env.meta.total_pages").alias("total_pages"),
        F.coalesce(F.size(F.col(f"_env.`{record_key}`")), F.lit(0)).alias("n_records"),
        *more,
    )


def _view() -> list[Column]:
    """The view columns; pages of an entity without views belong to view 0."""
    return [F.col("entity"), F.coalesce("view_id", F.lit(0)).alias("view_id")]


def end_page(rule: str) -> Column:
    """The page a scan ends at, as an aggregate over the heads of a view's pages."""
    first_page = F.max(F.when(F.col("ok") & (F.col("page") == 1), F.coalesce("total_pages", F.lit(1))))
    first_empty = F.min(F.when(F.col("ok") & (F.col("n_records") == 0), F.col("page")))
    first_last = F.min(F.when(F.col("ok") & (F.col("page") >= F.coalesce("total_pages", F.lit(1))), F.col("page")))
    return {
        FIRST_PAGE: F.least(first_page, first_empty),
        EVERY_PAGE: F.least(first_last, first_empty),
        UNTIL_EMPTY: first_empty,
        SINGLE: F.min(F.lit(1)),
    }[rule]


def view_ends(heads: DataFrame, rule: str) -> DataFrame:
    """Per view: the page its scan should end at, the last page in an unbroken run
    from page 1, and whether the run reaches the end.

    Breaks are found by joining each page to its successor on (view, page), which
    spreads one large view over all tasks where a window per view would not.
    """
    followed = (
        heads.filter("ok and page > 1")
        .select(*VIEW, (F.col("page") - 1).alias("page"))
        .distinct()
        .withColumn("followed", F.lit(True))
    )
    stops = F.col("ok") & F.col("followed").isNull()
    # Only the run from page 1 counts, so pages after a break cannot shorten it.
    return (
        heads.join(followed, [*VIEW, "page"], "left")
        .groupBy(*VIEW)
        .agg(
            end_page(rule).alias("end_page"),
            F.min(F.when(stops, F.col("page"))).alias("_run"),
            F.coalesce(F.max(F.col("ok") & (F.col("page") == 1)), F.lit(False)).alias("_starts"),
            F.count_distinct(F.when(F.col("ok"), F.col("page"))).alias("seen_pages"),
            F.count_if(~F.col("ok")).alias("failed_pages"),
        )
        .withColumn("run_end", F.when(F.col("_starts"), F.col("_run")).otherwise(0))
        .withColumn("is_complete", F.coalesce(F.col("run_end") >= F.col("end_page"), F.lit(False)))
        .drop("_run", "_starts")
    )


def page_completeness(pages: DataFrame, record_key: str, rule: str) -> DataFrame:
    """One row per view: expected, seen and failed pages, and whether the scan is whole."""
    ends = view_ends(page_heads(pages, record_key), rule)
    return ends.select(
        *VIEW,
        F.col("end_page").alias("expected_pages"),
        "seen_pages",
        "failed_pages",
        "is_complete",
    )


def read_pages(
    pages: DataFrame,
    record_key: str,
    record_type: str,
    rule: str = FIRST_PAGE,
    ends: DataFrame | None = None,
) -> DataFrame:
    """Records up to each view's scan end, with page and position: ``(…, pos, rec)``.

    ``ends`` is small by construction, one row per configured view, so it is broadcast;
    joining the pages on the view instead would send a large view to one task.
    """
    if ends is None:
        ends = view_ends(page_heads(pages, record_key), rule)
    # Every page up to the end of the unbroken run is usable.
    last = F.least("run_end", F.coalesce("end_page", "run_end"))
    limits = ends.select(F.col("entity").alias("_entity"), F.col("view_id").alias("_view"), last.alias("_last"))
    same_view = (F.col("entity") == F.col("_entity")) & (F.col("view_id") == F.col("_view"))
    envelope = f"STRUCT<`{record_key}`: ARRAY<{record_type}>>"
    return (
        pages.select(*_view(), "page", "body")
        .join(F.broadcast(limits), same_view & (F.col("page") <= F.col("_last")), "left_semi")
        .select(*VIEW, "page", F.posexplode(F.from_json("body", envelope)[record_key]).alias("pos", "rec"))
    )


def dedup_views(records: DataFrame, key: str, views: list[int] | None, place: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """One record per key: the copy read last, by view order and then by ``place``."""
    order = F.array_position(F.array(*[F.lit(v).cast("bigint") for v in views]), F.col("view_id")) if views else F.lit(0)
    ranked = records.withColumn("_view_order", order)
    return latest_per_key(ranked, [key], ["_view_order", *place]).drop("_view_order")


def since(df: DataFrame, column: str | Column, watermark, keep_unknown: bool = False) -> DataFrame:
    """Rows changed strictly after the watermark; all rows when there is none.

    ``keep_unknown`` also keeps rows that do not say when they changed.
    """
    if watermark is None:
        return df
    at = F.col(column) if isinstance(column, str) else column
    later = at > F.lit(str(watermark)).cast("timestamp_ntz")
    return df.filter(at.isNull() | later) if keep_unknown else df.filter(later)


def active_ids(
    pages: DataFrame,
    record_key: str,
    rule: str,
    views: list[int] | None = None,
    needs_view: bool = False,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Distinct ids now at the source, all or nothing: ``(entity, id)``.

    An entity with an incomplete view, with a configured view that never landed, or
    that needs views but has none configured yields no ids at all. ``heads`` are the
    pages' heads where they were already read.
    """
    if needs_view and not views:
        pages = pages.filter(F.lit(False))
    wanted = pages.filter(F.col("view_id").isin(views)) if views else pages
    if heads is None:
        heads = page_heads(wanted, record_key)
    elif needs_view and not views:
        heads = heads.filter(F.lit(False))
    elif views:
        heads = heads.filter(F.col("view_id").isin(views))
    ends = view_ends(heads, rule)
    whole = (
        ends.groupBy("entity")
        .agg(F.count_if("is_complete").alias("complete"), F.count("*").alias("landed"))
        .filter((F.col("complete") == F.col("landed")) & (F.col("landed") >= F.lit(len(views or [None]))))
        .select(F.col("entity").alias("_entity"))
    )
    found = read_pages(wanted, record_key, "STRUCT<id: BIGINT>", rule, ends)
    ids = found.select("entity", F.col("rec.id").alias("id")).filter("id is not null and id <> 0")
    # One row per registered entity at most, so broadcasting it is safe.
    return ids.join(F.broadcast(whole), F.col("entity") == F.col("_entity"), "left_semi").distinct()
