"""Mixing sources to target weights by entropy balancing.

Document rates r stay as near as possible to one copy each (least relative entropy) while
every source's words meet its target. The dual is convex with one number per source, and
its solution tilts rates exponentially by document size: r = min(cap, exp(lambda * size)).
Newton steps find lambda; each step is a sum over all documents, taken over the counts of
documents by source and size, which hold all that the sums need.

Rates become whole copies by size: copies of a size are the rounded steps of the running
total, one size is then adjusted to take up what is missing, and the copies of a size are
spread over its documents by hash, block by block. Only DataFrame functions are used, and
the driver sees single numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.llm.shared import stored
from tidemirror.operators.upsert import surrogate_keys
from tidemirror.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights go to sources in code point order, null last, and repeat."""

    weights: list[int] = field(default_factory=lambda: [5, 2, 1])
    share: float = 1.5
    cap: int = 2
    precision: float = 1e-10
    rounds: int = 60
    block_rows: int = 10_000


def sizes(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """Words of every document, and its source as a key that is never null."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("~")).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )


def targets(by_source: DataFrame, mix: Mix) -> DataFrame:
    """``source_size`` and ``target`` of every source; what capped sources leave is shared again."""
    spark = by_source.sparkSession
    # Keys begin with "s", or are "~" for null: their order is that of the sources, null last.
    ranked = surrogate_keys(by_source, ["source"], start=-1, column="place")
    weights = F.array(*map(F.lit, mix.weights))
    ranked = checkpointed(spark, ranked.withColumn("weight", F.get(weights, (F.col("place") % len(mix.weights)).cast("int"))))
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, limit = mix.share * total, F.col("source_size") * mix.cap
    # The share of one unit of weight grows until no further source is above its cap.
    unit, capped = 0.0, None
    while total:
        above = F.col("weight") * unit > limit
        n, taken, rest = ranked.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        if n == capped or not rest:
            break
        capped, unit = n, (budget - taken) / rest
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(float(unit)), limit.cast("double")).alias("target"))


def _tilted(mix: Mix) -> F.Column:
    return F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(mix.cap))))


def tilts(cells: DataFrame, wanted: DataFrame, mix: Mix) -> DataFrame:
    """``source``, ``tilt`` and ``mean``: the solution of the dual, by Newton steps that bisection guards."""
    spark = cells.sparkSession
    totals = cells.groupBy("source").agg(F.sum("n").alias("documents"))
    mean = F.col("source_size") / F.col("documents")
    # At the upper bound every rate is at the cap; at the lower one the words are too few.
    high = mean * math.log(mix.cap)
    # A source whose target is its cap has its solution there; steps from 0 would only halve their way to it.
    full = F.col("target") >= F.col("source_size") * mix.cap
    state = wanted.join(totals, "source").select(
        "source",
        "target",
        mean.alias("mean"),
        F.when(full, high).otherwise(0.0).alias("tilt"),
        F.least(mean * F.log(F.col("target") / F.col("source_size")), F.lit(0.0)).alias("low"),
        high.alias("high"),
        F.lit(False).alias("done"),
    )
    state = checkpointed(spark, state)
    for _ in range(mix.rounds):
        rate = _tilted(mix)
        words = F.col("n") * F.col("size") * rate
        free = F.col("tilt") * F.col("size") / F.col("mean") < math.log(mix.cap)
        # The state goes through the sums as their key, so a round is one join and one job.
        sums = cells.join(state, "source").groupBy(*state.columns).agg(
            F.sum(words).alias("words"), F.sum(F.when(free, words * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope")
        )
        step = F.col("tilt") - F.try_divide(F.log(F.col("words") / F.col("target")) * F.col("words"), F.col("slope"))
        low = F.when(F.col("words") <= F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("words") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        met = F.abs(F.col("words") / F.col("target") - 1) <= mix.precision
        moved = sums.select("source", "target", "mean", "tilt", "slope", low.alias("low"), high.alias("high"), step.alias("step"), met.alias("done"))
        inside = (F.col("slope") > 0) & (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        following = F.when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        moved = moved.withColumn("tilt", F.when(F.col("done"), F.col("tilt")).otherwise(following)).drop("slope", "step")
        state = checkpointed(spark, moved)
        if state.where("NOT done AND high - low > 1e-13").isEmpty():
            break
    # Sums in another order differ in the last digits only.
    return state.select("source", F.round("tilt", 10).alias("tilt"), "mean")


def _adjusted(cells: DataFrame, wanted: DataFrame, mix: Mix) -> DataFrame:
    """Copies of the one size per source that best take up the words still missing."""
    gap = cells.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).join(wanted, "source")
    gap = gap.select("source", (F.col("target") - F.col("taken")).alias("gap"))
    free = F.greatest(-F.col("copies"), F.least(F.col("n") * mix.cap - F.col("copies"), F.round(F.col("gap") / F.col("size")).cast("bigint")))
    options = cells.join(gap, "source").withColumn("more", free)
    rest = F.struct(F.abs(F.col("gap") - F.col("more") * F.col("size")), F.abs("more"), "size")
    best = options.groupBy("source").agg(F.min_by(F.struct("size", "more"), rest).alias("best"))
    best = best.select("source", F.col("best.size").alias("size"), F.col("best.more").alias("more"))
    return cells.join(best, ["source", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("more")


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", mix: Mix | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    A null source is a source of its own, the last. A null, empty or blank text has size 0
    and one copy that takes no words. Repeated rows are documents of their own, and rows
    without an id take part as all others. An empty table gives an empty result, other
    columns are ignored. Reruns give the same rows.
    """
    mix = mix or Mix()
    spark = docs.sparkSession
    rows = stored(sizes(docs, doc_id, source, text), "mix-sizes")
    cells = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-cells")
    wanted = checkpointed(spark, targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), mix))
    solid = cells.where("size > 0")
    goals = wanted.where("source_size > 0").select("source", "source_size", "target")
    tilted = solid.join(tilts(solid, goals, mix), "source").withColumn("expected", F.col("n") * _tilted(mix))
    # A source has at most as many sizes as its largest document has words.
    order = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.floor(F.sum("expected").over(order) + 0.5)
    before = F.floor(F.sum("expected").over(order) - F.col("expected") + 0.5)
    copies = F.greatest(F.lit(0), F.least(upto - before, F.col("n") * mix.cap)).cast("bigint")
    whole = stored(tilted.select("source", "size", "n", copies.alias("copies")), "mix-copies")
    for _ in range(2):
        whole = _adjusted(whole, goals.select("source", "target"), mix)
    whole = stored(whole, "mix-adjusted")

    blocks = max(64, rows.count() // mix.block_rows)
    placed = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    counts = placed.where("size > 0").groupBy("source", "size", "block").agg(F.count("*").alias("rows"))
    upto_block = Window.partitionBy("source", "size").orderBy("block")
    counts = counts.withColumn("cum", F.sum("rows").over(upto_block)).join(whole, ["source", "size"])
    extra = F.col("copies") % F.col("n")
    shared = counts.withColumn("extra", extra).select(
        "source",
        "size",
        "block",
        F.expr("copies div n").alias("each"),
        F.expr("(extra * cum) div n - (extra * (cum - rows)) div n").alias("more"),
    )
    at = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    numbered = placed.withColumn("at", at).join(shared, ["source", "size", "block"], "left")
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("each") + F.when(F.col("at") <= F.col("more"), 1).otherwise(0))
    return numbered.join(wanted, "source").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies.cast("bigint").alias("copies"),
        (copies * F.col("size")).cast("bigint").alias("taken"),
    )
