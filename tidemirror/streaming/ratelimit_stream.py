"""The rate limit on a stream: the batch operator per micro-batch, and two numbers per key in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemirror.operators.ratelimit import OPENED, USED, rate_limit_and_windows


def rate_limit_stream(
    events: DataFrame,
    key: str,
    ts: str,
    tie: str,
    *,
    root: str,
    limit: int = 10,
    window_seconds: int = 60,
) -> StreamingQuery:
    """Write ``events`` with ``allowed`` and ``remaining`` to ``root/out`` until the input is used up.

    Events are taken in time order within a micro-batch and in arrival order across
    micro-batches; one that is older than its key's open window counts in that window. A
    key's row of ``root/state`` is dropped once its window is over.

    A micro-batch writes its rows and the state after it under its own number, so a replay
    replaces what it wrote and begins from the same state.
    """
    options = {"limit": limit, "window_seconds": window_seconds}

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = spark.read.parquet(f"{root}/state/batch={batch_id - 1}") if batch_id else None
        carried = carried.select(key, OPENED, USED) if carried is not None else None
        rows, after = rate_limit_and_windows(batch, key, ts, tie, carried=carried, **options)
        rows.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")
        after.write.mode("overwrite").parquet(f"{root}/state/batch={batch_id}")
        if batch_id > 1:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/state/batch={batch_id - 2}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return (
        events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
