"""Upsert by key, row bookkeeping and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.operators.align import spare_names
from tidemirror.session import checkpointed

ACTION = "_action"
INSERT = "INSERT"
UPDATE = "UPDATE"
KEEP = "KEEP"

CREATED = "etl_created_at"
UPDATED = "etl_updated_at"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row per key in ``order``.

    The rank filter lets Spark drop all but one row per key in each task before the
    shuffle, so a key with very many copies sends at most one row per task.
    """
    newest = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    (place,) = spare_names(df, "_rank")
    return df.withColumn(place, rank).filter(F.col(place) == 1).drop(place)


def one_row_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch itself; the job fails when a key occurs twice.

    Only keys are counted, combined before their shuffle, so a repeated key cannot fill
    one task; the rows are shuffled once, by the keys the merge joins on.
    """
    counted = batch.groupBy(*keys).agg(F.count("*").alias("_n"))
    unique = F.assert_true(F.col("_n") == 1, "upsert: duplicate key in batch")
    checked = counted.filter(unique.isNull())
    # The flag keeps the check in the plan; a null key finds no match and stays.
    return batch.join(checked, list(keys), "left").filter("coalesce(_n, 1) = 1").select(*batch.columns)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: str | Sequence[str] = "id",
    *,
    order: Sequence[str | Column] | None = None,
    run_ts: str | None = None,
    version: str | None = None,
) -> DataFrame:
    """Merge ``batch`` into ``target`` and mark each row with its ``_action``.

    A matched key takes every batch value, nulls and unchanged values included; a
    new key is inserted; other target rows stay. With ``order`` the last copy of a
    repeated key wins, without it a repeated key fails the job. ``run_ts`` adds the
    bookkeeping times. ``version`` names a column whose older copies do not replace
    newer ones.

    Both sides meet in one full outer join. For a published table it gets only the
    slices that the batch touches, see ``Warehouse.change``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    batch = latest_per_key(batch, keys, order) if order else one_row_per_key(batch, keys)
    return _upsert_join(target, batch, keys, run_ts, version)


def _upsert_join(target, batch, keys, run_ts, version):
    columns = [c for c in target.columns if c not in keys and c not in (CREATED, UPDATED)]
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    b = batch.withColumn("_in_batch", F.lit(True)).alias("b")
    taken = "b._in_batch IS NOT NULL"
    if version:
        taken += f" AND NOT coalesce(b.`{version}` < t.`{version}`, false)"
    # Whole rows are chosen column by column; as SQL texts, wide tables plan quickly.
    # Columns the batch does not have keep the target's values.
    known = set(batch.columns)
    values = [f"CASE WHEN {taken} THEN b.`{c}` ELSE t.`{c}` END AS `{c}`" if c in known else f"t.`{c}`" for c in columns]
    if run_ts:
        now = f"TIMESTAMP_NTZ '{run_ts}'"
        old = CREATED in target.columns
        created, updated = (f"t.{CREATED}", f"t.{UPDATED}") if old else ["CAST(NULL AS TIMESTAMP_NTZ)"] * 2
        values += [
            f"CASE WHEN t._in_target IS NULL THEN {now} ELSE {created} END AS {CREATED}",
            f"CASE WHEN {taken} THEN {now} ELSE {updated} END AS {UPDATED}",
        ]
    inserted = f"{taken} AND t._in_target IS NULL"
    action = f"CASE WHEN {inserted} THEN '{INSERT}' WHEN {taken} THEN '{UPDATE}' ELSE '{KEEP}' END AS {ACTION}"
    return t.join(b, keys, "full_outer").selectExpr(*[f"`{k}`" for k in keys], *values, action)


def action_counts(merged: DataFrame) -> DataFrame:
    """Inserted and updated rows of a merge."""
    return merged.agg(
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
    )


def action_metrics() -> list[Column]:
    """The same counts as metrics of the write itself (for ``DataFrame.observe``)."""
    return [
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
    ]


def surrogate_keys(df: DataFrame, order: Sequence[str | Column] | None, start: int = 0, column: str = "id") -> DataFrame:
    """Number the rows ``start + 1, start + 2, …``, in a total ``order`` if one is given.

    Rows (range-sorted over all tasks for an order) are kept in the shared folder, because
    the counts per partition and the numbering must see the same partitions. Only one
    count per partition is gathered to shift each partition's own numbering.
    """
    part, row, moved = spare_names(df, "_part", "_row", "_shift")
    placed = checkpointed(df.sparkSession, df.sort(*order) if order else df)
    numbered = placed.withColumn(part, F.spark_partition_id()).withColumn(
        row, F.monotonically_increasing_id() - F.shiftleft(F.col(part).cast("bigint"), 33)
    )
    sizes = numbered.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort: at most spark.sql.shuffle.partitions rows.
    shift = sizes.select(F.col(part), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(moved))
    return (
        numbered.join(F.broadcast(shift), part)
        .withColumn(column, F.col(moved) + F.col(row) + F.lit(start + 1))
        .drop(part, row, moved)
    )
