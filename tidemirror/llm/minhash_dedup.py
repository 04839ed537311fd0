"""Near-duplicate documents by HyperMinHash sketches, confirmed on their full shingle sets.

A document's distinct word shingles are hashed to 64 bits. The leading bits choose one
of ``BUCKETS`` buckets; a bucket keeps its smallest hash as the number of leading zeros
and ten bits of mantissa, sixteen bits in all. Runs of registers (bands) that agree make
two documents candidates; there, an empty register stands in for the filled one that comes
first in an order of its own, so a band of a short document says as much as any other. Candidates are first judged by the share of agreeing
registers, corrected for agreement by chance, then by their full sets.

Documents with the same set are one class, whose smallest id stands for it. The documents
of a band are never expanded into all pairs: every one is compared with the smallest, and
after that only those of different components are compared with each other, block by block
inside tasks that pass on nothing but likely links.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import connected_components, stored
from tidemirror.llm.texts import counts_by_text, flat, hash_runs, hash_windows, is_space, lower_ascii, mix, runs, slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 5
BUCKETS = 256
ROWS = 8
MANTISSA = 10
# Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
# Registers may fall this many standard deviations short of the limit before a pair is dropped unread.
SLACK = 4.0
# Documents of one band that a task compares with as many others at a time.
BLOCK = 1024
_BITS = BUCKETS.bit_length() - 1
# Row i: the place of every bucket in the order in which an empty bucket i looks for a filled one.
_ORDER = np.argsort(np.random.default_rng(BUCKETS).random((BUCKETS, BUCKETS)), axis=1).astype(np.uint16)


def shingles(column: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer words is one shingle."""
    data, offsets = flat(column)
    data = lower_ascii(data)
    starts, ends = runs(~is_space(data), offsets)
    bounds = counts_by_text(starts, offsets).tolist()
    words = hash_runs(data, starts, ends)
    windows = hash_windows(words, size)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        else:
            out.append(hash_windows(words[a:b], b - a, salt=b - a) if b > a else np.zeros(0, np.uint64))
    return out


def sketch(hashes: np.ndarray) -> bytes:
    """Registers of a sorted set: 0 for an empty bucket, else leading zeros + 1 and the mantissa."""
    registers = np.zeros(BUCKETS, "<u2")
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rest = hashes[first] << np.uint64(_BITS)
        # The upper 53 bits are exact in a double, whose exponent gives the leading zeros.
        zeros = np.minimum(53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1], 53).astype(np.uint64)
        mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
        registers[bucket[first]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    return registers.tobytes()


def replaced(registers: np.ndarray) -> np.ndarray:
    """The registers of a sketch that has a filled one, with others in place of the empty ones."""
    filled, empty = np.flatnonzero(registers), np.flatnonzero(registers == 0)
    whole = registers.copy()
    if len(empty):
        whole[empty] = registers[filled[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]]
    return whole


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """A hash of every band of a sketch."""
    total = np.arange(1, BUCKETS // ROWS + 1, dtype=np.uint64)
    for column in replaced(registers).astype(np.uint64).reshape(-1, ROWS).T:
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + column)
    return total


def features(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, set size, a 128-bit hash of the set, and the registers."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            sets = shingles(batch.column("text"))
            sums = [[int(mix(s ^ np.uint64(seed)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for seed in (11, 29)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), *(pa.array(s, pa.int64()) for s in sums),
                 pa.array(map(sketch, sets), pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )

    return docs.mapInArrow(run, with_fields(docs.drop("text").schema, n_shingles="bigint", set_a="bigint", set_b="bigint", sketch="binary"))


def bands(reps: DataFrame) -> DataFrame:
    """One row per document and band: its hash, the document, and which of the bands it is."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hashes = [band_hashes(np.frombuffer(s.as_py(), "<u2")) for s in part.column("sketch")]
                band = pa.array(np.concatenate(hashes).view(np.int64))
                rep = pa.array(np.repeat(part.column("rep").to_numpy(), BUCKETS // ROWS))
                at_band = pa.array(np.tile(np.arange(BUCKETS // ROWS, dtype=np.int32), part.num_rows))
                yield pa.RecordBatch.from_arrays([band, rep, at_band], ["band", "rep", "nth"])

    return reps.select("rep", "sketch").mapInArrow(run, "band bigint, rep bigint, nth int")


def probable(equal: np.ndarray, filled: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether pairs may be linked, from their equal and filled registers and set sizes.

    Of two unlike minima, a register agrees by chance when both fall into the same cell:
    the same number of leading zeros, and one mantissa of 2 ** MANTISSA. The estimate
    corrected for that varies as a draw without replacement from the union of both sets.
    """
    edges = 2.0 ** -np.arange(0, 55)
    level = lambda n: np.diff((1 - edges) ** np.maximum(n[..., None] / BUCKETS, 1e-9))
    chance = np.abs(level(n_a) * level(n_b)).sum(axis=-1) / 2**MANTISSA
    limit, filled = PERCENT / 100, np.maximum(filled, 1)
    found = (equal / filled - chance) / (1 - chance)
    unseen = np.clip(1 - filled * (1 + limit) / (n_a + n_b), 0, 1)
    near = found >= limit - SLACK * np.sqrt(limit * (1 - limit) / filled * unseen) - 1 / filled
    # Sets whose sizes differ too much cannot be linked.
    return near & (100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b))


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose registers do not rule a link out."""
    left = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                a, b = (_registers(batch.column(k)) for k in ("s_a", "s_b"))
                equal, filled = ((a == b) & (a > 0)).sum(axis=1), ((a > 0) | (b > 0)).sum(axis=1)
                sizes = (batch.column(k).to_numpy().astype(float) for k in ("n_a", "n_b"))
                yield batch.select(["a", "b"]).filter(pa.array(probable(equal, filled, *sizes)))

    return both.mapInArrow(run, both.select("a", "b").schema)


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _compared(group: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Likely links between the documents of two blocks of a band, or within one, whose components differ.

    Two documents that share several bands are told by the first of them only.
    """
    rep, component, n = (group.column(k).to_numpy() for k in ("rep", "component", "n_shingles"))
    block, main = group.column("block").to_numpy(), group.column("main")[0].as_py()
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    registers = _registers(group.column("sketch"))
    stray, nth, whole = component != main, group.column("nth")[0].as_py(), {}
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    out = []

    def told(x: np.ndarray, y: np.ndarray) -> None:
        for k in {*x.tolist(), *y.tolist()} - whole.keys():
            whole[k] = replaced(registers[k])
        for at in range(0, len(x), 4096):
            u, v = x[at : at + 4096], y[at : at + 4096]
            same = np.stack([whole[k] for k in u]) == np.stack([whole[k] for k in v])
            first = same.reshape(len(u), -1, ROWS).all(axis=2).argmax(axis=1) == nth
            out.append((rep[u[first]], rep[v[first]]))

    def compare(x: np.ndarray, y: np.ndarray, twice: bool) -> None:
        empty_y = (registers[y] == 0).astype(np.float32)
        for at in range(0, len(x), 32):
            part = x[at : at + 32]
            mine = registers[part]
            equal = ((mine[:, None] == registers[y][None]) & (mine > 0)[:, None]).sum(axis=2)
            filled = BUCKETS - (mine == 0).astype(np.float32) @ empty_y.T
            near = probable(equal, filled, n[part].astype(float)[:, None], n[y].astype(float)[None])
            near &= component[part][:, None] != component[y][None]
            if twice:
                near &= ~(stray[y][None] & (part[:, None] >= y[None]))
            u, v = np.nonzero(near)
            told(part[u], y[v])

    if i == j:
        compare(left[stray[left]], left, True)
    else:
        compare(left[stray[left]], right, False)
        compare(right[stray[right]], left[~stray[left]], False)
    return out


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("s_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b")

    def run(batches):
        for batch in batches:
            kept = []
            for a, b in zip(batch.column("s_a"), batch.column("s_b")):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (a, b))
                shared = int((np.take(b, np.searchsorted(b, a), mode="clip") == a).sum())
                kept.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(run, both.select("a", "b").schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``rep`` and ``hashes``, the packed set, of the given documents."""

    def run(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), pa.array([s.tobytes() for s in shingles(batch.column("text"))], pa.binary())], ["rep", "hashes"]
            )

    return docs.mapInArrow(run, with_fields(docs.drop("text").schema, hashes="binary"))


def meetings(hits: DataFrame, components: DataFrame) -> DataFrame:
    """Every document of a band as often as its block meets another, with the two blocks ``i`` and ``j``.

    The strays of a band, those outside its largest component, have the first blocks and
    meet all blocks; the others meet the blocks of strays alone.
    """
    at = hits.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "nth", "rep", F.coalesce("component", "rep").alias("component")
    )
    sizes = at.groupBy("band", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.count("*").alias("kinds"), F.sum("n").alias("n"))
    at = at.join(mixed.where("kinds > 1").drop("kinds"), "band")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    at = at.withColumns({"strays": blocks(F.col("n") - F.col("n_main")), "mains": blocks(F.col("n_main")), "is_main": F.col("component") == F.col("main")})
    own = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    at = at.withColumn("block", F.when(F.col("is_main"), F.col("strays") + own(F.col("mains"))).otherwise(own(F.col("strays"))))
    met = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("strays") + F.when(F.col("is_main"), 0).otherwise(F.col("mains")) - 1)))
    return met.select("band", "nth", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "main", "rep", "component")


def apart(hits: DataFrame, components: DataFrame, reps: DataFrame) -> DataFrame:
    """Likely links between documents of one band in different components.

    Documents outside a band's largest component are compared with all of other components;
    two of the largest one need no comparison. A band is cut into blocks, and two blocks of
    it, of which one holds strays, meet in one task.
    """
    met = meetings(hits, components)
    rows = met.join(reps, "rep").select(*met.columns, "n_shingles", "sketch")
    key = ["band", "i", "j"]

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            keys = np.stack([table.column(k).to_numpy() for k in key])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(starts, starts[1:]):
                yield from told(table.slice(a, b - a))
            # The last group may go on in the next batch; it has at most two blocks.
            kept = table.slice(starts[-1]) if table.num_rows else kept
        if kept is not None and kept.num_rows:
            yield from told(kept)

    def told(group):
        for x, y in _compared(group):
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable by links, ``kept`` says the document has
    it. A null, empty or blank text has no shingles and no links. Rows that share an id are
    one document to the links. A row without an id is linked with nothing: its component is
    null and it is kept. An empty table gives an empty result, other columns are ignored.
    """
    found = stored(features(docs, doc_id, text), "minhash-features")
    usable = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    reps = usable.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    reps = stored(reps, "minhash-classes")
    rows = bands(reps)
    shared = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("first")).where("n > 1").drop("n")
    hits = stored(rows.join(shared, "band"), "minhash-bands")

    near = stored(likely(hits.where("rep != first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct(), reps), "minhash-near")
    # Members that are likely linked to their band's first one are left out of the second comparison ...
    rest = apart(hits, connected_components(near), reps).join(near, ["a", "b"], "left_anti")
    pairs = stored(near.unionByName(rest), "minhash-pairs")
    wanted = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).distinct()
    texts = docs.select(F.col(doc_id).cast("bigint").alias("rep"), F.col(text).cast("string").alias("text"))
    sets = stored(shingle_sets(texts.join(wanted, "rep", "left_semi")), "minhash-sets")
    links = stored(confirmed(pairs, sets), "minhash-links")
    components = connected_components(links)
    # ... and compared now if their full sets did not confirm it; their sets are at hand.
    late = stored(apart(hits, components, reps).join(pairs, ["a", "b"], "left_anti"), "minhash-late")
    if not late.isEmpty():
        components = connected_components(links.unionByName(confirmed(late, sets)))

    classes = reps.select("set_a", "set_b", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    return (
        found.drop("sketch")
        .join(classes, ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
