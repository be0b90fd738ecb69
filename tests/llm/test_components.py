import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtally.llm.components import _dealt, components, local_roots


def expected(edges):
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in parent}


CASES = {
    "chain": [(i, i + 1) for i in range(200)],
    "star": [(500, i) for i in range(300)],
    "random": [(random.Random(i).randrange(400), random.Random(-i - 1).randrange(400)) for i in range(300)],
    "repeated": [(1, 2), (2, 1), (1, 2), (-5, 2)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("part_edges", [10**6, 20])
def test_components(spark, name, part_edges):
    edges = [e for e in CASES[name] if e[0] != e[1]]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    rows = components(frame, part_edges).collect()
    assert {r.node: r.component for r in rows} == expected(edges)
    assert len(rows) == len({r.node for r in rows})


def test_edges_of_one_node_are_dealt_over_all_parts(spark):
    stars = spark.range(4000).selectExpr("7L AS a", "id + 10 AS b")
    parts = _dealt(stars, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 700
    assert components(stars, 500).filter("component = 7").count() == 4001


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_roots():
    nodes, roots = local_roots(np.array([5, 3, 9]), np.array([3, 4, 8]))
    assert dict(zip(nodes.tolist(), roots.tolist())) == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8}
