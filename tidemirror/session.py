"""Session settings and the shared working folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Source times carry no zone once loaded; a fixed session zone keeps casts reproducible.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Snapshots replace single date partitions and leave the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "tidemirror", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir``, or one beside the session's tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared folder, so later passes read the same rows."""
    shared_dir(spark)
    return df.checkpoint()


@contextmanager
def long_rows(spark: SparkSession, rows: int = 32) -> Iterator[None]:
    """Within this, Spark's column readers take at most ``rows`` rows at once.

    By default they hold 4,096, which for page bodies is a gigabyte. The setting belongs to the
    session and is read when a job starts, so what reads the pages has to run inside.
    """
    names = [f"spark.sql.{kind}.columnarReaderBatchSize" for kind in ("parquet", "orc")]
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in before.items():
            spark.conf.set(name, min(rows, int(value)))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
