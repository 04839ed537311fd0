"""Landed pages as a stream: a page passes once every page before it in its view has come."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemirror.sources import pages as P

_STATE = "entity STRING, view_id BIGINT, run_end INT, end_page INT, batch BIGINT"
_WAITING = P.PAGE_SCHEMA + ", ok BOOLEAN, total_pages INT, n_records INT"


@dataclass(frozen=True)
class PageGate:
    """Lets pages of micro-batches through in any order of arrival, as far as their view's scan is unbroken.

    Called with a micro-batch of landed pages and its number, it gives the usable pages that
    may be read now: those up to the last page of the unbroken run from page 1, and not past
    the scan's end. Over the whole input these are the pages a batch load reads. A copy of a
    page that has passed passes too; an unusable copy waits for a usable one. What has passed
    stays so, even if a later copy tells an earlier end.

    A view's row of the state tells how far its run reaches and where its scan ends; pages
    behind a gap are kept with their bodies until it closes. Two folders take turns, so a
    replayed micro-batch begins from the state it began from before.
    """

    root: str
    record_key: str
    rule: str = P.FIRST_PAGE

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        before, views = self._views(spark, batch_id - 1), f"{self.root}/views/{batch_id % 2}"
        arrived = P.page_heads(batch, self.record_key, "body")
        if batch_id:
            arrived = arrived.unionByName(_past(self._pages(spark, batch_id - 1), before))
        # Written once: the run, the pages that pass and those that go on waiting are read from it.
        arrived.write.mode("overwrite").parquet(f"{self.root}/pages/{batch_id % 2}")
        arrived = self._pages(spark, batch_id)
        after = _advance(before, arrived.drop("body"), self.rule)
        after.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(views)
        return _through(arrived, self._views(spark, batch_id))

    def state(self, spark: SparkSession) -> DataFrame:
        """Per view: the last page that may be read, where its scan ends, and whether it is whole."""
        known = spark.read.schema(_STATE).parquet(f"{self.root}/views/*")
        last = known.agg(F.max("batch").alias("_last"))
        # One row.
        latest = known.join(F.broadcast(last), F.col("batch") == F.col("_last"), "left_semi")
        whole = F.coalesce(F.col("run_end") >= F.col("end_page"), F.lit(False))
        return latest.select(*P.VIEW, "run_end", "end_page", whole.alias("is_complete"))

    def _views(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], _STATE).drop("batch")
        return spark.read.schema(_STATE).parquet(f"{self.root}/views/{batch_id % 2}").drop("batch")

    def _pages(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(_WAITING).parquet(f"{self.root}/pages/{batch_id % 2}")


def _placed(pages: DataFrame, views: DataFrame) -> DataFrame:
    # One row per configured view, so it is broadcast: a join on the view would send a large view to one task.
    limits = views.select(F.col("entity").alias("_entity"), F.col("view_id").alias("_view"), F.col("run_end").alias("_run"), F.col("end_page").alias("_end"))
    return pages.join(F.broadcast(limits), (F.col("entity") == F.col("_entity")) & (F.col("view_id") == F.col("_view")))


def _past(pages: DataFrame, views: DataFrame) -> DataFrame:
    """Pages that wait behind a gap; those past the end of their scan never pass."""
    return _placed(pages, views).filter("ok AND page > _run AND (_end IS NULL OR page <= _end)").select(*pages.columns)


def _through(pages: DataFrame, views: DataFrame) -> DataFrame:
    last = F.least("_run", F.coalesce("_end", "_run"))
    return _placed(pages, views).filter(F.col("ok") & (F.col("page") <= last)).select(*P.VIEW, "page", "body")


def _advance(before: DataFrame, heads: DataFrame, rule: str) -> DataFrame:
    """Every view's run and end after more pages have come."""
    told = heads.groupBy(*P.VIEW).agg(P.end_page(rule).alias("told"))
    # least takes the end that is known where one of them is not.
    ends = before.join(told, P.VIEW, "full").select(*P.VIEW, F.coalesce("run_end", F.lit(0)).alias("run_end"), F.least("end_page", "told").alias("end_page"))
    # The run's last page stands for all of it; a page without a successor ends a run.
    steps = heads.filter("ok").select(*P.VIEW, "page").unionByName(ends.select(*P.VIEW, F.col("run_end").alias("page"))).distinct()
    followed = steps.select(*P.VIEW, (F.col("page") - 1).alias("page"), F.lit(True).alias("followed"))
    stops = steps.join(followed, [*P.VIEW, "page"], "left").filter("followed IS NULL").drop("followed")
    run = _placed(stops, ends).filter("page >= _run").groupBy(*P.VIEW).agg(F.min("page").alias("run_end"), F.first("_end").alias("end_page"))
    return run.select(*P.VIEW, "run_end", "end_page")


def page_stream(pages: DataFrame, gate: PageGate, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand the pages that may be read to ``apply`` micro-batch by micro-batch, until the input is used up."""
    return (
        pages.writeStream.foreachBatch(lambda batch, batch_id: apply(gate(batch, batch_id), batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
