"""Bring rows to a target schema, and create or widen tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def align(df: DataFrame, schema: T.StructType, extra: bool = False) -> DataFrame:
    """Columns of ``schema`` in its order, missing ones as typed nulls.

    ``extra`` keeps columns the schema does not know, after the others.
    """
    have, names = set(df.columns), set(schema.names)
    known = []
    for f in schema:
        value = f"`{f.name}`" if f.name in have else "NULL"
        known.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
    more = [f"`{c}`" for c in df.columns if c not in names] if extra else []
    return df.selectExpr(*known, *more)


def evolve(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the union of their columns: the target's first, then new ones."""
    added = [f for f in batch.schema if f.name not in target.columns]
    schema = T.StructType([*target.schema, *added])
    return align(target, schema), align(batch, schema)


def ensure_columns(spark: SparkSession, current: DataFrame | None, schema: T.StructType) -> DataFrame:
    """A table as the schema wants it: empty when absent, widened when columns are missing."""
    if current is None:
        return spark.createDataFrame([], schema)
    return align(current, schema, extra=True)
