"""Merkle manifest of a table: trees of digests, kept as strings of whole levels.

Every row is a leaf. The rows of a group, in the order of their key, are the leaves of the
group's tree; the groups' roots, in order, are the leaves of the tree above them. Eight
consecutive nodes have one parent, the digest of their joined digests.

A tree is cut into aligned blocks of ``BLOCK`` nodes. A block keeps its nodes as one string
and the two levels above them as two more, made by hashing substrings of fixed width, since
the aligned block holds all children of each of its parents. The tops of a tree's blocks are
the nodes of the next height, until one block is left. What stands left and right of a node in
its run of eight, two substrings of a level, is what its proof needs of that level.

Places come from one range sort, blocks have a bounded number of rows, and each height has a
``BLOCK``-th of the rows of the one below, so no task meets a group as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import positions, small, stored

ARITY = 8
WIDTH = 64  # hexadecimal digits of a digest
RUN = ARITY * WIDTH
STEPS = 3
BLOCK = ARITY**STEPS
NO_GROUP = "-"


def told(column: str | Column) -> Column:
    """A value as it enters a leaf: its length in bytes and itself, or ``-`` for null."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: Sequence[str | Column]) -> Column:
    return F.sha2(F.concat(*map(told, fields)), 256)


def group_name(group: str) -> Column:
    """A group as a text that sorts as its bytes do, the null group first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(NO_GROUP))


@dataclass(frozen=True)
class Forest:
    """Trees as blocks by height. Columns: ``tree``, ``block``, ``n`` (nodes of the tree at this height), ``steps``
    (levels that lead from the nodes to the block's top), ``l0`` to ``l2`` and ``top``; the lowest also ``members``."""

    heights: list[DataFrame]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """The trees of the groups, and the one tree above their roots."""

    groups: Forest
    above: Forest

    @property
    def root(self) -> DataFrame:
        """One row with ``root``; none for an empty table."""
        return self.above.roots.select(F.col("node").alias("root"))


def _parents(level: str) -> str:
    """The digests of each run of eight, as one string."""
    count = f"cast((octet_length({level}) - 1) div {RUN} as int)"
    each = f"sha2(substring({level}, i * {RUN} + 1, {RUN}), 256)"
    return f"cast(array_join(transform(sequence(0, {count}), i -> {each}), '') as binary)"


def _blocks(nodes: DataFrame, sizes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """Nodes (``tree``, ``pos``, ``node``) as blocks; ``sizes`` tells ``n`` of every tree."""
    members = F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("members")
    found = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(members)
    found = found.join(small(sizes), "tree")
    # One select per level, or the levels below would be hashed again for each above.
    found = found.withColumn("l0", F.expr("cast(array_join(transform(members, m -> m.node), '') as binary)"))
    if payload:
        found = found.withColumn("members", F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in payload])))
    else:
        found = found.drop("members")
    found = found.withColumn("l1", F.expr(_parents("l0"))).withColumn("l2", F.expr(_parents("l1")))
    steps = F.when(F.col("n") > ARITY**2, STEPS).when(F.col("n") > ARITY, 2).when(F.col("n") > 1, 1).otherwise(0)
    # A block of a larger tree is led to its top in full, however few nodes its last one has.
    found = found.withColumn("steps", steps)
    return stored(found.withColumn("top", F.expr(f"cast(CASE steps WHEN 0 THEN l0 WHEN 1 THEN l1 WHEN 2 THEN l2 ELSE {_parents('l2')} END as string)")), name)


def forest(leaves: DataFrame, payload: list[str], name: str) -> Forest:
    """Trees over ``leaves`` (``tree``, ``pos`` from 0 without gaps, ``node``); ``payload`` columns stay with the leaves."""
    leaves = stored(leaves, f"{name}-leaves")
    sizes = stored(leaves.groupBy("tree").agg(F.count("*").alias("n")), f"{name}-sizes")
    # One number: how many nodes the largest tree has.
    most = sizes.agg(F.max("n")).first()[0] or 0
    heights, nodes, roots = [], leaves, None
    while True:
        blocks = _blocks(nodes, sizes, payload if not heights else [], f"{name}-{len(heights)}")
        heights.append(blocks)
        ended = blocks.where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("node"))
        roots = ended if roots is None else roots.unionAll(ended)
        if most <= BLOCK:
            return Forest(heights, roots)
        most = -(-most // BLOCK)
        nodes = blocks.where(F.col("n") > BLOCK).select("tree", F.col("block").alias("pos"), F.col("top").alias("node"))
        sizes = sizes.where(F.col("n") > BLOCK).select("tree", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"))


def manifest(
    docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of a table; ``carry`` names columns that stay with the leaves, for ``proofs``.

    Nulls in any field are told as such. A null group is a group, the first; null keys come
    first in theirs, and rows that share a key are ordered by their leaves, so repeated rows are
    leaves of their own next to each other. Columns that are not named take no part, whatever their names. An empty
    table has no root.
    """
    carried = {f"c_{c}": value for c, value in (carry or {}).items()}
    rows = docs.select(group_name(group).alias("tree"), F.col(key).alias("at"), leaf(fields).alias("node"), *[v.alias(c) for c, v in carried.items()])
    # Written before the sort, which reads its rows twice: texts are hashed once.
    placed = positions(stored(rows, "merkle-rows"), "tree", ["at", "node"])
    groups = forest(placed.select("tree", "pos", "node", *carried), list(carried), "merkle-groups")
    tops = positions(groups.roots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "node"), "all", ["name"])
    return Manifest(groups, forest(tops.select(F.col("all").alias("tree"), "pos", "node", "name"), ["name"], "merkle-above"))


def _siblings(steps: int) -> str:
    """SQL: what stands left and right of node ``i`` of a block, level by level."""
    pairs = []
    for level in range(steps):
        j = f"(i div {ARITY**level})"
        run = f"({j} div {ARITY} * {RUN})"
        left = f"substring(l{level}, cast({run} + 1 as int), cast({j} * {WIDTH} - {run} as int))"
        right = f"substring(l{level}, cast(({j} + 1) * {WIDTH} + 1 as int), cast({run} + {RUN} - ({j} + 1) * {WIDTH} as int))"
        pairs.append(f"named_struct('left', cast({left} as string), 'right', cast({right} as string))")
    return f"slice(array({', '.join(pairs)}), 1, steps)"


def _paths(woods: Forest, outer: DataFrame, payload: list[str]) -> DataFrame:
    """``tree``, ``pos``, ``node``, ``path``, the columns ``outer`` has besides, and the payload, for every leaf.

    ``outer`` has ``tree`` and ``path``, what leads on from each tree's root.
    """
    more = [c for c in outer.columns if c not in ("tree", "path")]
    above, found = None, None
    for height in reversed(range(len(woods.heights))):
        blocks = woods.heights[height]
        ended = blocks.where(F.col("n") <= BLOCK).select("tree").join(outer, "tree").withColumn("block", F.lit(0).cast("bigint"))
        keys = ended if above is None else ended.unionByName(above.select("tree", F.col("pos").alias("block"), "path", *more))
        own = payload if height == 0 else []
        nodes = f"substring(l0, cast(i * {WIDTH} + 1 as int), {WIDTH})"
        member = ", ".join(["block * {0} + i as pos".format(BLOCK), f"cast({nodes} as string) as node", f"{_siblings(STEPS)} as own", *[f"get(members, i).{c} as {c}" for c in own]])
        each = f"transform(sequence(0, cast(octet_length(l0) div {WIDTH} as int) - 1), i -> struct({member}))"
        rows = blocks.join(keys, ["tree", "block"]).select("tree", "path", *more, F.explode(F.expr(each)).alias("m"))
        found = rows.select("tree", "m.pos", "m.node", F.concat("m.own", "path").alias("path"), *more, *[F.col(f"m.{c}").alias(c) for c in own])
        above = found
    return found


def proofs(whole: Manifest, carry: Sequence[str] = ()) -> DataFrame:
    """One row per leaf: ``group`` (as ``group_name`` tells it), ``pos``, ``leaf``, ``subroot``, ``root``, ``path`` and what was carried.

    ``path`` holds what stands left and right of the node on each level, from the leaf to the root.
    """
    nothing = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    top = whole.above.roots.select("tree", nothing.alias("path"), F.col("node").alias("root"))
    outer = _paths(whole.above, top, ["name"]).select(F.col("name").alias("tree"), "path", F.col("node").alias("subroot"), "root")
    outer = small(stored(outer, "merkle-outer"))
    rows = _paths(whole.groups, outer, [f"c_{c}" for c in carry])
    return rows.select(F.col("tree").alias("group"), "pos", F.col("node").alias("leaf"), "subroot", "root", "path", *[F.col(f"c_{c}").alias(c) for c in carry])


def siblings(path: str = "path") -> Column:
    """All siblings of a path in one string."""
    return F.array_join(F.flatten(F.transform(path, lambda x: F.array(x["left"], x["right"]))), "")


def folded(node: str | Column, path: str = "path") -> Column:
    """The root that a path leads to from ``node``."""
    node = F.col(node) if isinstance(node, str) else node
    return F.aggregate(path, node, lambda done, x: F.sha2(F.concat(x["left"], done, x["right"]), 256))


def changed_blocks(old: Manifest, new: Manifest) -> DataFrame:
    """``group``, ``block`` and what became of it: lowest blocks whose top is another, or that one manifest lacks.

    Blocks are compared, not rows: a ``BLOCK``-th of the table.
    """
    before, after = (
        m.groups.heights[0].select(F.col("tree").alias("group"), "block", F.struct("top", F.octet_length("l0").alias("size")).alias(side)) for m, side in ((old, "old"), (new, "new"))
    )
    state = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return before.join(after, ["group", "block"], "full_outer").where("NOT old <=> new").select("group", "block", state.alias("state"))
