"""Rows held inside records: child arrays, id lists and option lists.

``keep`` names columns of the record's row that its items carry on, ``place`` a column for
an item's position, so that the last of several copies is defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _exploded(records: DataFrame, items: str | Column, keep: list[str | Column], place: str | None) -> DataFrame:
    item = F.posexplode(items).alias(place, "_item") if place else F.explode(items).alias("_item")
    return records.select(*keep, item)


def nested_items(records: DataFrame, array: str | Column, keep: list[str | Column] | None = None, place: str | None = None) -> DataFrame:
    """All items of a nested array as ``_item``; a null or empty array gives none."""
    return _exploded(records, array, keep or [], place)


def nested_children(records: DataFrame, array: str) -> DataFrame:
    """All items of a nested struct array, flattened."""
    return nested_items(records, array).select("_item.*")


def children_with_parent(records: DataFrame, parent: str | Column, array: str | Column, parent_column: str) -> DataFrame:
    """Items of a nested struct array, each with its parent's key."""
    key = F.col(parent) if isinstance(parent, str) else parent
    return nested_items(records, array, [key.alias(parent_column)]).select(parent_column, "_item.*")


def relation_pairs(records: DataFrame, parent: str | Column, array: str | Column, parent_column: str, item_column: str) -> DataFrame:
    """(parent, item) pairs of an id list."""
    key = F.col(parent) if isinstance(parent, str) else parent
    return nested_items(records, array, [key.alias(parent_column)]).withColumnRenamed("_item", item_column)


def first_choices(fields: Column, name: str) -> Column:
    """Choices of the first field definition with the given name."""
    return F.get(F.filter(fields, lambda f: f["name"] == name), F.lit(0))["choices"]


def option_list(records: DataFrame, fields: str, name: str) -> DataFrame:
    """Choices of the first field definition with the given name, flattened."""
    return nested_items(records, first_choices(F.col(fields), name)).select("_item.*")
