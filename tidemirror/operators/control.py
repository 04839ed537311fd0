"""The audit table, the watermark it supplies, and run totals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS = "SUCCESS"
ERROR = "ERROR"

# Columns of the audit table.
AUDIT_SCHEMA = """
    entity_name STRING, last_execution_date TIMESTAMP_NTZ, execution_status STRING,
    records_extracted BIGINT, records_inserted BIGINT, records_updated BIGINT, records_failed BIGINT,
    error_message STRING, execution_duration_seconds BIGINT
"""

# Run totals also need the delete counts, which the audit table does not keep.
# Sweep figures and the outcome of the reconcile tell why rows were deleted or not.
OUTCOME_SCHEMA = AUDIT_SCHEMA + """,
    records_deleted BIGINT, records_cascade_deleted BIGINT, kind STRING,
    records_active BIGINT, pages_read BIGINT, reconcile STRING
"""

# Fixed value: the zone audit times are shown in.
REPORT_ZONE = "America/Santiago"

FULL = "full"
FIRST = "first"
INCREMENTAL = "incremental"


def audit_rows(spark: SparkSession, rows: Iterable[tuple], schema: str = AUDIT_SCHEMA) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def append_audit(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """The audit table with new rows, in its own column order."""
    return audit.unionByName(rows.select(*audit.columns))


def shown_local(audit: DataFrame, zone: str = REPORT_ZONE) -> DataFrame:
    """Audit times, kept in UTC, as naive local times of ``zone``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("last_execution_date"))
    return audit.withColumn("last_execution_date", local)


def last_success(audit: DataFrame) -> DataFrame:
    """Watermark of every entity: its latest successful run."""
    return (
        audit.filter(F.col("execution_status") == SUCCESS)
        .groupBy("entity_name")
        .agg(F.max("last_execution_date").alias("watermark"))
    )


def load_modes(entities: DataFrame, audit: DataFrame, force_full: bool = False) -> DataFrame:
    """How each entity is read: ``(entity_name, incremental, mode, watermark)``.

    ``entities`` has the columns ``entity_name, incremental``. A full load has no watermark.
    """
    marks = last_success(audit)
    full = F.lit(force_full) | ~F.col("incremental")
    mode = F.when(full, FULL).when(F.col("watermark").isNull(), FIRST).otherwise(INCREMENTAL)
    return entities.join(marks, "entity_name", "left").select(
        "entity_name", "incremental", mode.alias("mode"), F.when(~full, F.col("watermark")).alias("watermark")
    )


def latest_runs(audit: DataFrame, n: int = 10, tie_break: str = "entity_name") -> DataFrame:
    """Newest runs first."""
    return audit.orderBy(F.col("last_execution_date").desc(), F.col(tie_break)).limit(n)


def failed_runs(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("execution_status") == ERROR)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Totals of one run over its outcome rows; only failed entities fail the run."""
    entity = F.col("kind") == "entity"
    failed = F.col("execution_status") == ERROR
    counters = ["extracted", "inserted", "updated", "deleted", "cascade_deleted", "failed"]
    counted = {c: F.when(entity, F.col(f"records_{c}").cast("bigint")) for c in counters}
    sums = [F.coalesce(F.sum(value), F.lit(0)).alias(f"total_{c}") for c, value in counted.items()]
    return outcomes.agg(
        *sums,
        F.count_if(entity & ~failed).alias("entities_ok"),
        F.count_if(entity & failed).alias("entities_failed"),
        F.count_if(~entity & ~failed).alias("steps_ok"),
        F.count_if(~entity & failed).alias("steps_failed"),
        F.coalesce(F.bool_or(entity & failed), F.lit(False)).alias("run_failed"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table (an empty table counts 0)."""
    counts = [df.agg(F.lit(name).alias("entity"), F.count("*").alias("total")) for name, df in tables.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result
