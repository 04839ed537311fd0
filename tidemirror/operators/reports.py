"""Steps run after the load: dated snapshots, the reporting fact, and the step runner."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemirror.operators.control import ERROR, OUTCOME_SCHEMA, SUCCESS, audit_rows

SNAPSHOT_DATE = "snapshot_date"

MONEY = "decimal(18,2)"


def dated(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(SNAPSHOT_DATE, F.lit(day).cast("date"))


def append_snapshot(history: DataFrame, rows: DataFrame, day: str) -> DataFrame:
    """History with the day's copy of ``rows``; a rerun on the same day replaces its copy."""
    other_days = history.filter(F.col(SNAPSHOT_DATE) != F.lit(day).cast("date"))
    return other_days.unionByName(dated(rows, day))


def write_snapshot(rows: DataFrame, day: str, path: str) -> None:
    """Write only the day's partition; the other days are neither read nor rewritten."""
    (
        dated(rows, day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT_DATE)
        .parquet(path)
    )


def snapshot_of(history: DataFrame, day: str) -> DataFrame:
    """One day's copy (a partition filter on the stored history)."""
    return history.filter(F.col(SNAPSHOT_DATE) == F.lit(day).cast("date"))


def deal_product_fact(
    deals: DataFrame,
    deal_products: DataFrame,
    products: DataFrame | None = None,
    deal_columns: tuple[str, ...] = ("name", "pipeline_name", "stage_name", "owner_id", "closed_date"),
) -> DataFrame:
    """One row per deal and product: lines, quantity and amounts in exact decimals.

    Lines are summed before any join, so a deal with very many lines reaches the
    join as one row per product.
    """
    discounted = F.col("total_price").cast(MONEY) * (1 - F.coalesce("discount", F.lit(0)).cast("decimal(6,4)"))
    lines = deal_products.groupBy("deal_id", "product_id").agg(
        F.count("*").alias("line_count"),
        F.sum(F.col("quantity").cast(MONEY)).alias("quantity"),
        F.sum(F.col("total_price").cast(MONEY)).alias("gross_amount"),
        F.sum(discounted).alias("net_amount"),
    )
    kept = [c for c in deal_columns if c in deals.columns]
    heads = deals.select(F.col("id").alias("deal_id"), *[F.col(c).alias(f"deal_{c}") for c in kept])
    fact = lines.join(heads, "deal_id")
    if products is not None:
        names = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
        fact = fact.join(names, "product_id", "left")
    return fact


def run_steps(spark: SparkSession, steps: list[tuple[str, Callable[[], object]]]) -> DataFrame:
    """Run named steps in order, each on its own; one outcome row per step."""
    rows = []
    for name, step in steps:
        began = time.monotonic()
        at = datetime.now(timezone.utc).replace(tzinfo=None)
        status, message = SUCCESS, None
        try:
            step()
        except Exception as error:
            status, message = ERROR, str(error)
        seconds = int(time.monotonic() - began)
        rows.append((name, at, status, 0, 0, 0, 0, message, seconds, 0, 0, "step", None, None, None))
    return audit_rows(spark, rows, OUTCOME_SCHEMA)


def step_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("kind = 'step'").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("execution_status") == SUCCESS).alias("success"),
        F.count_if(F.col("execution_status") == ERROR).alias("failed"),
    )
