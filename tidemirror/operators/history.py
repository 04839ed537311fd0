"""Snapshots as validity intervals: a row is stored once per change instead of once per day.

A history has the columns of the snapshots and ``valid_from`` and ``valid_to``: the row is in
every snapshot from the first day on and before the second, ``OPEN`` if it is in the newest
one. Rows are compared by all their columns, nulls as equal; rows that repeat every column
within a day are one. Intervals of equal rows neither meet nor overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.operators.align import spare_names
from tidemirror.operators.reports import SNAPSHOT_DATE

VALID_FROM, VALID_TO = "valid_from", "valid_to"
OPEN = "9999-12-31"
BOUNDS = [VALID_FROM, VALID_TO]


def _day(day: str):
    return F.lit(day).cast("date")


def begin_history(rows: DataFrame, day: str) -> DataFrame:
    """The history whose only snapshot is that of ``day``."""
    return rows.distinct().select("*", _day(day).alias(VALID_FROM), _day(OPEN).alias(VALID_TO))


def put_snapshot(history: DataFrame, rows: DataFrame, day: str, next_day: str | None = None) -> DataFrame:
    """``history`` with ``rows`` as the snapshot of ``day``, in place of what it said of that day.

    A rerun with the same rows changes nothing. A late snapshot names the ``next_day`` for
    which there is one already; that day and later ones keep their rows. Intervals that ended
    before the day, or begin after the next one, are passed on without a shuffle: only rows
    valid around the day meet the new ones, by all columns.
    """
    until = next_day or OPEN
    if not day < until:
        raise ValueError(f"snapshot of {day} after its next day {until}")
    columns = [c for c in history.columns if c not in BOUNDS]
    away = (F.col(VALID_TO) < _day(day)) | (F.col(VALID_FROM) > _day(until))
    near = history.where(~away)
    before = near.where(F.col(VALID_FROM) < _day(day)).withColumn(VALID_TO, F.least(VALID_TO, _day(day)))
    after = near.where(F.col(VALID_TO) > _day(until)).withColumn(VALID_FROM, F.greatest(VALID_FROM, _day(until)))
    new = rows.distinct().select(*columns, _day(day).alias(VALID_FROM), _day(until).alias(VALID_TO))
    pieces = before.unionByName(after).unionByName(new)
    # Pieces of equal rows that meet become one.
    row = Window.partitionBy(*columns).orderBy(VALID_FROM)
    opens = F.coalesce(F.lag(VALID_TO).over(row) < F.col(VALID_FROM), F.lit(True))
    first, group = spare_names(history, "_first", "_island")
    island = F.sum(first).over(row.rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.withColumn(first, opens.cast("int")).withColumn(group, island)
    merged = placed.groupBy(*columns, group).agg(F.min(VALID_FROM).alias(VALID_FROM), F.max(VALID_TO).alias(VALID_TO))
    return history.where(away).unionByName(merged.drop(group))


def from_daily(copies: DataFrame) -> DataFrame:
    """The history of a table of daily copies, whose days are told by ``snapshot_date``."""
    columns = [c for c in copies.columns if c != SNAPSHOT_DATE]
    # One row per day there ever was.
    at, following, group = spare_names(copies, "_at", "_next", "_island")
    by_day = Window.orderBy(SNAPSHOT_DATE)
    days = copies.select(SNAPSHOT_DATE).distinct().select(
        SNAPSHOT_DATE, F.row_number().over(by_day).alias(at), F.coalesce(F.lead(SNAPSHOT_DATE).over(by_day), _day(OPEN)).alias(following)
    )
    placed = copies.distinct().join(F.broadcast(days), SNAPSHOT_DATE)
    island = F.col(at) - F.row_number().over(Window.partitionBy(*columns).orderBy(at))
    return placed.withColumn(group, island).groupBy(*columns, group).agg(
        F.min(SNAPSHOT_DATE).alias(VALID_FROM), F.max(following).alias(VALID_TO)
    ).drop(group)


def snapshot_on(history: DataFrame, day: str) -> DataFrame:
    """The rows of one day: a filter on the bounds, which reaches the files."""
    return history.where((F.col(VALID_FROM) <= _day(day)) & (F.col(VALID_TO) > _day(day))).drop(*BOUNDS)


def daily(history: DataFrame, days: list[str]) -> DataFrame:
    """The copies of the given snapshot days, with ``snapshot_date``."""
    listed = F.array(*[_day(d) for d in sorted(set(days))])
    inside = F.filter(listed, lambda d: (d >= F.col(VALID_FROM)) & (d < F.col(VALID_TO)))
    return history.withColumn(SNAPSHOT_DATE, F.explode(inside)).drop(*BOUNDS)
