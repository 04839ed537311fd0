"""Tables in the shared folder, places of rows in their groups, and connected components."""

from __future__ import annotations

from uuid import uuid4

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.session import checkpointed, shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared folder and read back, so a lost executor costs no earlier stage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    # The schema is known, so no job reads it from the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A side of more rows than this is never broadcast; it is joined by a shuffle.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``SMALL_ROWS`` rows, which are counted."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def positions(df: DataFrame, group: str, order: Sequence[str | Column], column: str = "pos") -> DataFrame:
    """Rows with their place in their group from 0, in a total ``order``; a null group is one of its own.

    One range sort by group and order spreads a large group over many tasks. A row's place is
    its place in its part of the sort and what the parts before it have of its group, so only
    counts per part and group are brought together. The sort is kept in the shared folder,
    because counts and places must see the same parts. ``df`` has no column that begins with
    an underscore.
    """
    placed = checkpointed(df.sparkSession, df.sort(group, *order)).withColumn("_part", F.spark_partition_id())
    numbered = placed.withColumn("_row", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33))
    parts = numbered.groupBy("_part", F.col(group).alias("_group")).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = stored(parts.select("_part", "_group", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "positions")
    other = small(shift.withColumnRenamed("_part", "_own"))
    found = numbered.join(other, (F.col("_part") == F.col("_own")) & F.col(group).eqNullSafe(F.col("_group")))
    return found.select(*df.columns, (F.col("_row") + F.col("_shift")).alias(column))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that links lead to; nodes without links are left out.

    Alternating large and small stars: every node's links move to the smallest neighbour
    until all of them point at the root. A node that half of all links share is met by
    partial aggregation and by joins that adaptive execution splits. Nothing but a count
    and a checksum of the links reaches the driver.
    """
    spark = edges.sparkSession
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = checkpointed(spark, edges.where(F.col(a) != F.col(b)).select(high, low).distinct())
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        links = checkpointed(spark, small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct())
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == seen:
            break
        seen = now
    root = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        root.select("node", F.col("node").alias("component"))
    )
