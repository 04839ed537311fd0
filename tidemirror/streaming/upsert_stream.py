"""Keep a published table in step with a stream of changed rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemirror.operators.upsert import upsert
from tidemirror.warehouse import Warehouse


def upsert_stream(
    changes: DataFrame,
    warehouse: Warehouse,
    table: str,
    *,
    checkpoint: str,
    order: Sequence[str | Column],
    key: str = "id",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    version: str | None = None,
    release: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into ``table`` until the input is used up.

    ``prepare`` turns the micro-batch into rows with the table's columns and those
    of ``order`` (for landed pages: read, project, split). The last copy of a key
    wins; ``version`` also keeps an older copy from replacing a newer row. ``release`` comes
    first and holds back what may not be read yet (for pages out of order: a ``PageGate``).

    Only the slices a micro-batch touches are rewritten. The table's properties tell the last
    micro-batch that was merged, so a replayed one does nothing; should the job die before that
    is told, the replay merges the same rows again, which changes nothing either.
    """
    mark = f"mirror.stream-{crc32(checkpoint.encode())}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        if int(warehouse.marks(table).get(mark, -1)) >= batch_id:
            return
        if release:
            batch = release(batch, batch_id)
        rows = warehouse.stage(prepare(batch) if prepare else batch, f"{table}-batch")

        def merge(part: DataFrame, changed: DataFrame) -> DataFrame:
            return upsert(part, changed, key, order=order, version=version)

        warehouse.change(table, rows, merge).commit()
        warehouse.mark(table, **{mark: batch_id})

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
