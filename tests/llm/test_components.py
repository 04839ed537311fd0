"""Connected components against union-find."""

import random

from tidemirror.llm.shared import connected_components


def test_random_graphs_chains_and_stars(spark):
    draw = random.Random(7)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5), (9999, 9999)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in linked} and len(got) == len(linked)
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0
