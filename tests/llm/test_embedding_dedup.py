"""Links and components against all pairs of double-precision cosines."""

import collections
import math

import numpy as np
import pytest

from tidemirror.llm import embedding_dedup as E

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, n STRING, rep INT"


def brute_force(rows, limit=0.93):
    usable = lambda v, label: v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows if i is not None and usable(v, label)]
    root, degree = {i: i for i, _, _ in rows}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a, label) in enumerate(good):
        for j, b, other in good[:n]:
            if label == other and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= limit:
                degree[i] += 1
                degree[j] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (degree[i], find(i)) for i, _, _ in rows}


def vectors(seed, n=200, dimension=32):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dimension))
    rows = []
    for i in range(n):
        near = centres[draw.integers(12)] + draw.standard_normal(dimension) * draw.choice([0.1, 0.2, 0.3, 2.0])
        rows.append((i, [float(np.float32(x)) for x in near], int(draw.integers(3))))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]
    return rows


@pytest.mark.parametrize("block", [16, 1024])
def test_links_agree_with_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = vectors(1)
    got = E.near_duplicates(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)).collect()
    want = brute_force(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_vectors_that_cannot_link(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.5]
    rows = [(1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1),
            (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.5, 0.0], 1), (12, [2.0, 1.0], 1), (13, [-1.0, -0.5], 1), (14, [-0.0, 1.0], 3), (15, [0.0, 1.0], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in [*rows, (None, one, 1)]], SCHEMA)
    got = {r["vec_id"]: r for r in E.near_duplicates(df).collect()}
    want = brute_force(rows)
    assert {i: (got[i]["n_links"], got[i]["component_id"]) for i in want} == want
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, True)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_the_count_keeps_the_recall_of_pairs_at_the_limit():
    settings = E.Projections()
    draw, dimension = np.random.default_rng(3), 48
    matrix = settings.matrix(dimension)[:, 1:]
    found = 0
    for _ in range(2000):
        a = draw.standard_normal(dimension)
        a /= np.linalg.norm(a)
        b = draw.standard_normal(dimension)
        b -= a * (a @ b)
        b = settings.limit * a + math.sqrt(1 - settings.limit**2) * b / np.linalg.norm(b)
        found += E.collisions((a @ matrix)[None], (b @ matrix)[None], settings.window * settings.distance)[0, 0] >= settings.count
    assert found >= 1990
    loose = E.Projections(recall=0.9)
    assert loose.count > settings.count


def test_query_agrees_with_all_pairs(spark, sf):
    from tidemirror.llm.queries import QUERIES

    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op8_embedding_dedup"](spark, sf).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute_force(rows)


def test_query_agrees_with_its_sql_on_planted_copies(spark, sf, tmp_path):
    import duckdb

    from tidemirror.llm.queries import ORACLES, QUERIES

    draw = np.random.default_rng(5)
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in table.collect()]
    first, planted = max(i for i, _, _ in rows) + 1, []
    for n, (_, vector, label) in enumerate(rows[::5]):
        # Equal, scaled, near and far copies, some of them under another label.
        v = np.array(vector, float)
        away = draw.standard_normal(len(v)) * np.linalg.norm(v) / math.sqrt(len(v))
        for share in (0, 0.1, 0.3, 0.35, 0.45):
            planted.append((first + len(planted), [float(x) for x in v * (1 + n % 2) + (1 + n % 2) * share * away], label if n % 7 else None))
    table.unionByName(spark.createDataFrame(planted, table.schema)).write.parquet(f"{tmp_path}/embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    columns = "vec_id, n_links, component_id, kept"
    want = set(db.execute(f"SELECT {columns} FROM ({ORACLES['op8_embedding_dedup']})").fetchall())
    got = {tuple(r) for r in QUERIES["op8_embedding_dedup"](spark, str(tmp_path)).select(*columns.split(", ")).collect()}
    assert got == want and sum(n > 0 for _, n, _, _ in want) > len(planted) / 3
