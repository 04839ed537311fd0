"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Unit vectors are projected on many random directions. On one direction two vectors
collide when one lies in the window around the other. The difference of two vectors at
distance d is normal with deviation d on a Gaussian direction, so the count of collisions
of a pair at the similarity limit is binomial: the count asked for is the largest that
such a pair reaches with probability ``recall``. Pairs that reach it are verified by their
cosine in double precision.

Equal vectors are one class. Within a label, vectors sorted by their first projection are
cut into blocks of ``BLOCK``; a task counts the collisions of two blocks. Blocks whose first
projections lie further apart than two linked vectors ever can are not paired. Apart from
that, comparing windows of one dimension grows with the square of a label's distinct
vectors; no pair is stored unless it reaches the count.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import connected_components, stored
from tidemirror.operators.upsert import surrogate_keys

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024
LIMIT = 0.93


@dataclass(frozen=True)
class Projections:
    """Directions, window and count; the window is given in distances of a pair at the limit."""

    limit: float = LIMIT
    directions: int = 48
    window: float = 1.5
    recall: float = 0.9999
    seed: int = 7

    @property
    def distance(self) -> float:
        return math.sqrt(2 - 2 * self.limit)

    def matrix(self, dimension: int) -> np.ndarray:
        """Gaussian directions as columns; the first has length one, so that distances bound its differences."""
        out = np.random.default_rng([self.seed, dimension]).standard_normal((dimension, self.directions + 1))
        out[:, 0] /= np.linalg.norm(out[:, 0])
        return out

    @property
    def count(self) -> int:
        """The largest count that a pair at the limit reaches with probability ``recall``."""
        p, n = math.erf(self.window / math.sqrt(2)), self.directions
        below = 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if below > 1 - self.recall:
                return k
        return n


def collisions(a: np.ndarray, b: np.ndarray, window: float) -> np.ndarray:
    """For every row of ``a`` and of ``b``, the number of directions on which they collide."""
    out = np.zeros((len(a), len(b)), np.uint8)
    for k in range(a.shape[1]):
        # The window of every row of a is a range of b's sorted values; comparing beats gathering the range.
        out += np.abs(a[:, k : k + 1] - b[None, :, k]) <= window
    return out


def linked(a: np.ndarray, b: np.ndarray, settings: Projections, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` whose collisions reach the count and whose cosine reaches the limit."""
    lengths = [np.sqrt((x * x).sum(axis=1)) for x in (a, b)]
    directions = settings.matrix(a.shape[1])[:, 1:]
    pa_, pb = ((x / n[:, None] @ directions).astype(np.float32) for x, n in zip((a, b), lengths))
    found = []
    for at in range(0, len(a), 256):
        i, j = np.nonzero(collisions(pa_[at : at + 256], pb, settings.window * settings.distance + 1e-6) >= settings.count)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 4096):
            x, y = i[part : part + 4096], j[part : part + 4096]
            good = (a[x] * b[y]).sum(axis=1) / (lengths[0][x] * lengths[1][y]) >= settings.limit
            found.append((x[good], y[good]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def links_between(classes: DataFrame, settings: Projections) -> DataFrame:
    """``a`` < ``b``: linked classes (``rep``, ``label``, ``dimension``, ``vector``) of one label."""

    def first(batches):
        for batch in batches:
            out = []
            for v in batch.column("vector"):
                x = np.array(v.as_py(), float)
                out.append(float(x @ settings.matrix(len(x))[:, 0] / math.sqrt(float(x @ x))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "first"])

    schema = classes.select("*", F.lit(0.0).alias("first")).schema
    # Vectors are numbered by label and first projection: consecutive numbers make a block.
    numbered = surrogate_keys(classes.mapInArrow(first, schema), ["label", "dimension", "first", "rep"], start=-1, column="at")
    blocked = numbered.withColumn("block", F.expr(f"at div {BLOCK}"))
    ranges = blocked.groupBy("label", "dimension", "block").agg(F.min("first").alias("low"), F.max("first").alias("high"))
    far = settings.distance + 1e-9
    left = ranges.select("label", "dimension", F.col("block").alias("x"), F.col("high").alias("high_x"))
    right = ranges.select("label", "dimension", F.col("block").alias("y"), F.col("low").alias("low_y"))
    paired = left.join(right, ["label", "dimension"]).where(f"x <= y AND low_y - high_x <= {far}").select("label", "dimension", "x", "y")
    sides = paired.select("*", F.explode(F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))).alias("block"))
    # A pair of blocks holds at most 2 * BLOCK vectors.
    rows = blocked.select("label", "dimension", "block", "rep", "vector").join(sides, ["label", "dimension", "block"])

    def compare(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        block = table.column("block").to_numpy()
        reps, vectors = table.column("rep").to_numpy(), _numbers(table.column("vector"))
        i, j = block == x, block == y
        a, b = linked(vectors[i], vectors[j], settings, x == y)
        u, v = reps[i][a], reps[j][b]
        return pa.table({"a": np.minimum(u, v), "b": np.maximum(u, v)})

    return rows.groupBy("label", "dimension", "x", "y").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Projections | None = None
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest
    id that links lead to. Vectors that are null, empty, zero or hold a null or non-finite
    component, and vectors without a label, link with nothing; so do rows without an id,
    whose component is null and which are kept. Vectors of different lengths never link.
    Rows that share an id are one to the links of others. An empty table gives an empty
    result, other columns are ignored.
    """
    settings = settings or Projections()
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    solid = finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(solid & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    classes = rows.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("dimension", F.size("vector")), "embedding-classes")
    links = stored(links_between(classes.drop("n"), settings), "embedding-links")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionAll(links.select("b", "a"))
    sizes = classes.groupBy(F.col("rep").alias("other")).agg(F.sum("n").alias("n"))
    degree = ends.join(sizes, "other").groupBy("rep").agg(F.sum("n").alias("others"))
    components = connected_components(links).withColumnRenamed("node", "rep")
    known = classes.join(degree, "rep", "left").join(components, "rep", "left").select(
        "label",
        "vector",
        F.lit(True).alias("usable"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return rows.join(known, ["label", "vector", "usable"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
