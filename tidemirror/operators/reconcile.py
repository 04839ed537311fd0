"""Delete rows that no longer exist at the source, behind safety guards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.operators.children import cascade

APPLIED = "applied"
LOAD_FAILED = "skipped_load_failed"
INCOMPLETE = "skipped_incomplete"
NO_SWEEP = "skipped_no_sweep"
NOT_ALLOWED = "skipped_not_allowed"
EMPTY = "skipped_empty"


@dataclass
class Reconciled:
    """Rows that stay and rows to delete, with the children of both."""

    outcome: str
    kept: DataFrame
    deleted: DataFrame
    kept_children: dict[str, DataFrame]
    deleted_children: dict[str, DataFrame]


def missing_ids(target: DataFrame, active: DataFrame, key: str = "id") -> DataFrame:
    """Ids of the target that are not active (an anti join, which null ids cannot upset)."""
    return target.select(key).join(active.select(key), key, "left_anti")


def id_blocks(ids: DataFrame, key: str = "id") -> DataFrame:
    """``block`` and ``ids``: the whole-number ids of each block of 32,768 as one bitmap; null ids are left out.

    Every task makes a bitmap per block it meets, so one row per block and task is shuffled,
    however many ids there are and however often they repeat.
    """
    at = F.col(key).cast("bigint")
    placed = ids.where(F.col(key).isNotNull()).select(F.shiftright(at, 15).alias("block"), at.bitwiseAND(F.lit(32767)).alias("place"))
    return placed.groupBy("block").agg(F.bitmap_construct_agg("place").alias("ids"))


def missing_whole_ids(target: DataFrame, active: DataFrame, key: str = "id") -> DataFrame:
    """``missing_ids`` for whole numbers: the difference of two id sets, a row per block instead of one per id.

    Ids come out once each. Where ids lie far apart a bitmap of 4 KB is more than the ids
    themselves, and ``missing_ids`` is the better way, as it is for texts.
    """
    ours, theirs = id_blocks(target, key), id_blocks(active, key).withColumnRenamed("ids", "known")
    both = ours.join(theirs, "block", "left")
    bits = "sequence(0, 7)"
    byte = "cast(conv(hex(substring({0}, i + 1, 1)), 16, 10) as int)"
    ours_at, theirs_at = byte.format("ids"), f"coalesce({byte.format('known')}, 0)"
    left = f"transform(sequence(0, octet_length(ids) - 1), i -> {ours_at} & ~{theirs_at})"
    kept = both.select("block", F.expr(left).alias("left"))
    # An untouched block goes before its bytes are looked at one by one.
    kept = kept.where("exists(left, b -> b <> 0)").select("block", F.posexplode("left").alias("byte", "value")).where("value <> 0")
    found = kept.select("block", "byte", "value", F.explode(F.expr(bits)).alias("bit")).where("value & shiftleft(1, bit) <> 0")
    return found.select(F.expr("block * 32768 + byte * 8 + bit").alias(key))


def guard(
    *,
    failed: int = 0,
    complete: bool = True,
    table: str | None = None,
    allowed: set[str] | None = None,
    active: DataFrame | None = None,
) -> str:
    """The first reason not to delete, or ``applied``."""
    if failed > 0:
        return LOAD_FAILED
    if not complete or active is None:
        return INCOMPLETE
    if active.isEmpty():
        return EMPTY
    if allowed is not None and table not in allowed:
        return NOT_ALLOWED
    return APPLIED


def reconcile(
    target: DataFrame,
    active: DataFrame | None,
    key: str = "id",
    *,
    children: dict[str, tuple[DataFrame, str]] | None = None,
    failed: int = 0,
    complete: bool = True,
    table: str | None = None,
    allowed: set[str] | None = None,
) -> Reconciled:
    """Split the target into active and deleted rows, children following their parents.

    ``children`` maps a child table to its rows and parent column. When a guard
    holds, nothing is deleted.
    """
    children = children or {}
    outcome = guard(failed=failed, complete=complete, table=table, allowed=allowed, active=active)
    if outcome != APPLIED:
        nothing = F.lit(False)
        return Reconciled(
            outcome,
            target,
            target.filter(nothing),
            {name: rows for name, (rows, _) in children.items()},
            {name: rows.filter(nothing) for name, (rows, _) in children.items()},
        )
    ids = active.select(key)
    deleted = target.join(ids, key, "left_anti")
    split = {name: cascade(rows, deleted, parent, key) for name, (rows, parent) in children.items()}
    return Reconciled(
        outcome,
        target.join(ids, key, "left_semi"),
        deleted,
        {name: pair[0] for name, pair in split.items()},
        {name: pair[1] for name, pair in split.items()},
    )
