"""Replace the rows that belong to parents: child rows and relation pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.operators.upsert import CREATED, UPDATED


def replace_children(
    old: DataFrame,
    new: DataFrame,
    parent: str,
    *,
    parents: DataFrame | None = None,
    run_ts: str | None = None,
) -> DataFrame:
    """Old rows of untouched parents plus the batch's rows.

    A parent is touched when it has at least one row in ``new``; ``parents`` (one
    column named as ``parent``) adds parents whose list became empty.
    """
    touched = new.select(parent)
    if parents is not None:
        touched = touched.unionByName(parents.select(parent))
    kept = old.join(touched.distinct(), parent, "left_anti")
    if run_ts:
        now = F.lit(run_ts).cast("timestamp_ntz")
        new = new.withColumn(CREATED, now).withColumn(UPDATED, now)
    return kept.unionByName(new, allowMissingColumns=True)


def replace_relations(old: DataFrame, new: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Relation pairs after a load: every parent of the batch loses its old pairs.

    Repeated pairs of the batch are kept once.
    """
    kept = old.join(parents.select(parent).distinct(), parent, "left_anti")
    return kept.unionByName(new.distinct(), allowMissingColumns=True)


def cascade(children: DataFrame, deleted: DataFrame, parent: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Children that stay, and children whose parent was deleted."""
    gone = deleted.select(F.col(key).alias(parent)).distinct()
    return children.join(gone, parent, "left_anti"), children.join(gone, parent, "left_semi")
