"""Dimension lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame,
    dimension: DataFrame | None,
    foreign_key: str,
    column: str,
    *,
    key: str = "id",
    value: str = "name",
) -> DataFrame:
    """Add ``column`` from the dimension; null when unmatched or without a dimension.

    Whether the dimension is broadcast is left to the optimizer, which knows its bytes.
    """
    if dimension is None:
        return rows.withColumn(column, F.lit(None).cast("string"))
    pairs = dimension.select(F.col(key).alias("_dim_key"), F.col(value).alias(column))
    found = rows.drop(column).join(pairs, F.col(foreign_key) == F.col("_dim_key"), "left")
    return found.drop("_dim_key")
