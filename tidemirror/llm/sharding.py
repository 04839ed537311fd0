"""Sharding by vector bin packing: bytes, tokens and rows of all shards balanced together.

Rows of equal text are a group, a vector of its bytes, tokens and rows as parts of a shard's
even share. Each group goes to the shard where the dot product with what the shard has left is
highest; bytes weigh most in it, as their balance is the law that is kept.

A group above a shard's share in any dimension is dealt out in pieces. The largest groups, a
bounded number, are packed first. All others meet in blocks of groups of like size, each block
with its part of what the shards have left by then, and a last fifth of the blocks is packed
after the rest has been counted, so that what the blocks missed is made up.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import positions, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAW = "bytes"
# Bytes that a row takes besides its text.
ROW_BYTES = 16
WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ["b", "t", "r"]
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
_PLACED = "key string, piece bigint, b double, t double, r double, n bigint, shard int"


@dataclass(frozen=True)
class Packing:
    """Weights are those of bytes, tokens and rows.

    A group above a share becomes pieces of at most ``1 / pieces`` of it. Groups above
    ``1 / head`` of a share, at most ``3 * shards * head``, are packed first. Items that have
    ``1 / often`` of all rows, at most ``often``, reach their rows by a broadcast.
    """

    shards: int = 40
    weights: tuple[float, float, float] = (8.0, 1.0, 1.0)
    pieces: int = 8
    head: int = 64
    block_items: int = 1000
    last: float = 0.2
    often: int = 2000


def place(items: np.ndarray, left: np.ndarray, weights: np.ndarray, seed: int) -> np.ndarray:
    """The shard of each item (rows of ``DIMENSIONS``), taken in order; ``left`` is what each shard has left.

    Equal products go to the first shard of an order that the seed deals out.
    """
    order = np.random.default_rng(seed).permutation(len(left))
    left, out = left[order].copy(), np.empty(len(items), np.int32)
    weighted = items * weights
    for i in range(len(items)):
        at = int(np.argmax(left @ weighted[i]))
        left[at] -= items[i]
        out[i] = at
    return order[out]


def packer(left: np.ndarray, volume: np.ndarray | None, weights: tuple[float, ...]):
    """A function that packs one block into its part of ``left``; ``volume`` is that of all blocks, none for a block that has all."""
    weights = np.array(weights)

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        largest = (block[DIMENSIONS].to_numpy() * weights).max(axis=1)
        block = block.assign(w=largest).sort_values(["w", "b", "key", "piece"], ascending=[False, False, True, True], kind="stable")
        items = block[DIMENSIONS].to_numpy()
        own = left
        if volume is not None:
            own = left * np.divide(items.sum(axis=0), volume, out=np.zeros(3), where=volume > 0)
        seed = int(block["block"].iloc[0]) * 64 + int(block["tier"].iloc[0])
        return block[["key", "piece", *DIMENSIONS, "n"]].assign(shard=place(items, own, weights, seed))

    return pack


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """Groups with their number of rows, and a row's size and tokens, which equal texts share."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max("size").alias("size"), F.max("tokens").alias("tokens"))


def _items(rows: DataFrame, packing: Packing) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``piece``, and items (``key``, ``piece``, parts of a share, ``n``)."""
    # One row.
    total = rows.agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).first()
    share = {d: (total[d] or 0) / packing.shards or 1.0 for d in DIMENSIONS}
    parts = {
        "b": F.col("n") * F.col("size") / F.lit(float(share["b"])),
        "t": F.col("n") * F.col("tokens") / F.lit(float(share["t"])),
        "r": F.col("n") / F.lit(float(share["r"])),
    }
    groups = stored(_counted(rows, "key").withColumns(parts), "shard-groups")
    most = F.greatest(*DIMENSIONS)
    # At most 3 * shards groups have more than a shard's share of something.
    large = groups.where((F.col("n") > 1) & (most > 1)).select("key", F.least(F.ceil(most * packing.pieces), F.col("n")).alias("pieces"))
    large = F.broadcast(stored(large, "shard-large"))
    # Rows of one id are dealt out too, by where they are in the written table.
    dealt = F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc", "at"), F.col("pieces")))
    pieced = rows.join(large, "key", "left").withColumn("piece", dealt.cast("bigint")).drop("pieces")
    split = _counted(pieced.join(large.select("key"), "key", "left_semi"), "key", "piece").withColumns(parts)
    whole = groups.join(large.select("key"), "key", "left_anti").withColumn("piece", F.lit(0).cast("bigint"))
    return pieced, whole.unionByName(split).select("key", "piece", *DIMENSIONS, "n")


def pack(items: DataFrame, packing: Packing) -> DataFrame:
    """Items with their ``shard``."""
    weighted = F.greatest(*[F.col(d) * w for d, w in zip(DIMENSIONS, packing.weights, strict=True)])
    tier = F.floor(-F.log(weighted) / math.log(8)).cast("int")
    head = F.greatest(*DIMENSIONS) > 1 / packing.head
    late = F.pmod(F.xxhash64("key", "piece", F.lit(1)), F.lit(1000)) < int(packing.last * 1000)
    phase = F.when(head, 0).when(late, 2).otherwise(1)
    placed = stored(items.withColumns({"phase": phase, "tier": F.when(head, 0).otherwise(tier)}), "shard-items")
    # One row per phase and power of eight.
    volumes = placed.groupBy("phase", "tier").agg(F.count("*").alias("items"), *[F.sum(d).alias(d) for d in DIMENSIONS]).collect()
    left, done = np.ones((packing.shards, 3)), []
    for now in range(3):
        mine = [v for v in volumes if v["phase"] == now]
        if not mine:
            continue
        # Phase 1 leaves to phase 2 its part of what is left.
        volume = np.array([sum(v[d] for v in volumes if v["phase"] >= now) for d in DIMENSIONS]) if now else None
        blocks = F.lit(1)
        for v in mine:
            blocks = F.when(F.col("tier") == v["tier"], max(1, v["items"] // packing.block_items if now else 1)).otherwise(blocks)
        blocked = placed.where(F.col("phase") == now).withColumn("block", F.pmod(F.xxhash64("key", "piece"), blocks))
        found = stored(blocked.groupBy("tier", "block").applyInPandas(packer(left, volume, packing.weights), _PLACED), f"shard-placed-{now}")
        # One row per shard.
        for load in found.groupBy("shard").agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).collect():
            left[load["shard"]] -= [load[d] for d in DIMENSIONS]
        done.append(found)
    out = done[0] if done else items.limit(0).withColumn("shard", F.lit(0))
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "piece", "n", "shard")


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", packing: Packing | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all if not given) and ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is that of the text in bytes and ``ROW_BYTES``; a null text has none and is a group
    apart from the empty one. Slots are the places of a shard's rows, without gaps. Rows without an id and
    repeated rows are rows like all others and get slots of their own. ``grown_shard`` is null, as more shards
    need another packing. An empty table gives an empty result; columns named as the added ones
    are replaced. A rerun over the same files gives the same shards.
    """
    packing = packing or Packing()
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(c) for c in kept]).alias("row"),
        F.col(doc_id).alias("doc"),
        F.when(F.col(text).isNull(), F.lit("")).otherwise(F.md5(whole)).alias("key"),
        (F.octet_length(whole) + ROW_BYTES).cast("bigint").alias("size"),
        F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("tokens"),
        F.crc32(whole).alias("crc"),
    )
    # Written once: places in the written table deal out rows of one id.
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "shard-rows")
    pieced, items = _items(rows, packing)
    placed = pack(items, packing)
    total = rows.count()
    common = F.broadcast(stored(placed.where(F.col("n") * packing.often >= total), "shard-common"))
    keys = ["key", "piece"]
    seen = pieced.join(common.select(*keys, "shard"), keys)
    rest = pieced.join(common.select(*keys), keys, "left_anti")
    others = placed.where(F.col("n") * packing.often < total).select(*keys, "shard")
    sharded = seen.unionByName(rest.join(others, keys)).select("row", "doc", "key", "at", "size", "crc", "shard")
    numbered = positions(sharded, "shard", ["key", "doc", "at"], "slot")
    return numbered.select(
        "row.*", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """The rows as files by shard, each shard's in the order of slots; a shard may have many files."""
    placed = assigned.withColumn("part", F.expr(f"slot div {rows_per_file}"))
    placed.repartition("shard", "part").sortWithinPartitions("shard", "slot").write.partitionBy("shard", "part").parquet(path)
