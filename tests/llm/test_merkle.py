"""Trees against a plain recursion, proofs, tampering, differences of manifests."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemirror.llm import merkle as M

FIELDS = ("doc_id", "source", "lang", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def brute_force(rows, fields=FIELDS):
    """Of every leaf: group, leaf, subroot, root and path."""
    groups = collections.defaultdict(list)
    for r in rows:
        key = (r["doc_id"] is not None, r["doc_id"] or 0)
        groups[None if r["lang"] is None else r["lang"].encode()].append((key, leaf([r[f] for f in fields])))
    names = sorted(groups, key=lambda g: (g is not None, g or b""))
    trees = {g: levels([n for _, n in sorted(groups[g])]) for g in names}
    above = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, node in enumerate(trees[g][0]):
            out.append((g if g is None else g.decode(), node, trees[g][-1][0], above[-1][0], path(trees[g], i) + path(above, k)))
    return out


def proven(whole):
    rows = M.proofs(whole).withColumn("folded", M.folded("leaf")).collect()
    assert all(r["folded"] == r["root"] for r in rows)
    name = lambda g: None if g == "-" else g[1:]
    return sorted((name(r["group"]) or "", r["pos"], r["leaf"], r["subroot"], r["root"], [tuple(x) for x in r["path"]]) for r in rows)


def listed(expected):
    seen = collections.Counter()
    out = []
    for group, *rest in expected:
        out.append((group or "", seen[group], *rest))
        seen[group] += 1
    return sorted(out)


@pytest.mark.parametrize("sizes", [[1], [8, 9], [64, 65, 1], [511, 512, 513], [4097, 2]])
def test_trees_of_all_sizes(spark, sizes):
    rows = [(i, "s", f"g{g}", f"text {i}") for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, lang STRING, text STRING").repartition(5)
    assert proven(M.manifest(docs, fields=FIELDS)) == listed(brute_force([dict(zip(FIELDS, r, strict=True)) for r in rows]))


def test_many_groups(spark):
    """More groups than a block of the tree above holds."""
    rows = [(1, "s", f"{g:x}", "t") for g in range(600)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, lang STRING, text STRING")
    assert proven(M.manifest(docs, fields=FIELDS)) == listed(brute_force([dict(zip(FIELDS, r, strict=True)) for r in rows]))


def test_odd_documents_and_an_empty_table(odd, none):
    whole = M.manifest(odd, fields=FIELDS)
    expected = brute_force(odd.collect())
    assert proven(whole) == listed(expected)
    assert [r["root"] for r in whole.root.collect()] == [expected[0][3]]
    empty = M.manifest(none, fields=FIELDS, carry={"doc_id": F.col("doc_id")})
    assert empty.root.collect() == [] and M.proofs(empty, ["doc_id"]).collect() == []


def test_a_group_named_as_null_is_told(spark):
    """A group called ``-`` or without a name at all is another than the null group."""
    rows = [(1, "s", None, "t"), (1, "s", "-", "t"), (1, "s", "", "t"), (1, "s", "é", "t"), (1, "s", "z", "t")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, lang STRING, text STRING")
    whole = M.manifest(docs, fields=FIELDS)
    want = brute_force([dict(zip(FIELDS, r, strict=True)) for r in rows])
    assert sorted((r["leaf"], r["root"], [tuple(x) for x in r["path"]]) for r in M.proofs(whole).collect()) == sorted((w[1], w[3], w[4]) for w in want)


def test_levels_are_kept_as_strings(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("x").alias("lang"))
    lowest, highest = M.manifest(docs, fields=("doc_id",)).groups.heights
    want = levels([leaf([i]) for i in range(1000)])
    got = lowest.orderBy("block").collect()
    for k, width in enumerate((512, 64, 8)):
        assert "".join(r[f"l{k}"].decode() for r in got) == "".join(want[k])
        assert len(got[0][f"l{k}"]) == 64 * width
    assert [r["top"] for r in got] == want[3] and [r["top"] for r in highest.collect()] == want[4]


def test_changed_blocks(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("lang"), F.lit("a").alias("text"))
    fields = ("doc_id", "text")
    old = M.manifest(docs, fields=fields)
    new = M.manifest(docs.withColumn("text", F.when(F.col("doc_id") == 1999, "b").otherwise("a")).where("doc_id < 1024 OR lang = '1'"), fields=fields)
    got = sorted(tuple(r) for r in M.changed_blocks(old, new).collect())
    # Group 0 loses its second block, the last document of group 1 lies in its second one.
    assert got == [("=0", 1, "removed"), ("=1", 1, "changed")]
    assert M.changed_blocks(old, old).isEmpty()


def test_query_tells_tampered_documents(spark, sf):
    import zlib

    from tidemirror.llm.queries import FIELDS as ALL
    from tidemirror.llm.queries import QUERIES

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = {w[1]: w for w in brute_force(docs.values(), ALL)}
    rows = QUERIES["op13_merkle_manifest"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        doc = docs[r["doc_id"]].asDict()
        _, node, subroot, root, steps = want[leaf([doc[f] for f in ALL])]
        if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and doc["text"] is not None:
            doc["text"] = doc["text"].translate(lower)
        folded = leaf([doc[f] for f in ALL])
        for left, right in steps:
            folded = sha(left + folded + right)
        assert list(r) == [r["doc_id"], node, subroot, root, sha("".join(a + b for a, b in steps)), folded, folded == root]
    assert 0 < sum(r["verified"] for r in rows) < len(rows)
