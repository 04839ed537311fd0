"""Statistics of scans that add up: sketches per entity and run, united over any set of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Registers of the distinct count, as a power of two: its relative standard error is 1.04 / sqrt(2^14) = 0.8 %.
LG_K = 14
# Items kept by the quantile sketch: a quantile's rank is off by 1.33 % at most, 99 times of 100.
QUANTILE_K = 200


def scan_statistics(rows: DataFrame, by: Sequence[str], key: str, measure: str) -> DataFrame:
    """One row per group: ``rows``, sketch ``ids`` of the distinct keys and sketch ``sizes`` of the measure.

    Sketches are built in each task and merged, so a group of any size sends a few kilobytes
    per task through the shuffle. Null keys and null measures count as rows only; a group
    without keys or measures has a null sketch there. An empty table gives no rows.
    """
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.when(F.count(key) > 0, F.hll_sketch_agg(key, LG_K)).alias("ids"),
        F.when(F.count(measure) > 0, F.kll_sketch_agg_double(F.col(measure).cast("double"), QUANTILE_K)).alias("sizes"),
    )


def put_statistics(kept: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """The kept rows with those of a run; a run that is repeated replaces its own, so it counts once."""
    return kept.join(new.select(*by), list(by), "left_anti").unionByName(new)


def united(statistics: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of several runs as one per group, with the same columns.

    Quantile sketches drop items by chance, so estimates may differ between evaluations within their error.
    """
    return statistics.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.when(F.count("ids") > 0, F.hll_union_agg("ids")).alias("ids"),
        F.when(F.count("sizes") > 0, F.kll_merge_agg_double("sizes")).alias("sizes"),
    )


def told(statistics: DataFrame, ranks: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Estimates in place of the sketches: ``distinct_ids`` and one ``size_p<percent>`` for each rank."""
    others = [c for c in statistics.columns if c not in ("ids", "sizes")]
    quantiles = [F.when(F.col("sizes").isNotNull(), F.kll_sketch_get_quantile_double("sizes", F.lit(r))).alias(f"size_p{round(r * 100)}") for r in ranks]
    return statistics.select(*others, F.coalesce(F.hll_sketch_estimate("ids"), F.lit(0)).alias("distinct_ids"), *quantiles)
