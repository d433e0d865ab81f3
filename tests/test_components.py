import random

from lectern.operators.components import connected_components
from lectern.operators.ordering import numbered


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_random_chains_loops_and_hubs(spark):
    random.seed(1)
    ids = [f"n{i:04d}" for i in range(400)]
    edges = [(random.choice(ids[:150]), random.choice(ids[:150])) for _ in range(90)]
    edges += list(zip(ids[150:230], ids[151:231], strict=True)) + [(ids[230], ids[150])]  # a long loop
    edges += [(x, ids[240]) for x in ids[241:400]]  # a hub
    edges += edges[:20]
    df = spark.createDataFrame([*edges, (None, "n0001"), ("n0002", None), ("n0399", "n0399")], "a string, b string")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_numbered(spark):
    rows = spark.range(1000).selectExpr("id", "(id * 37) % 1000 as k")
    assert all(r.k == r.row for r in numbered(rows, "k").collect())
