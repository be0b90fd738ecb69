"""Connected components of an edge table.

Edges are first contracted in parts of bounded expected size, each within one task; the
edges of one node are dealt over all parts. If one part is enough this is the answer; otherwise the contracted edges go through alternating large-star
and small-star steps until all of them hang on roots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import stored

#: Expected edges of a part.
PART_EDGES = 1 << 18
_STAR = "u long, v long"


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of an edge list and the smallest node of the component of each."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        # Hook the roots of both ends on the smaller one, then follow all chains to their end.
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(np.asarray(x.column(0)), np.asarray(x.column(1))) for x in batches]
    if held:
        nodes, roots = local_roots(*(np.concatenate(c) for c in zip(*held)))
        away = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(roots[away])], ["u", "v"])


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on its smallest neighbour."""
    if large:
        pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = pairs.join(least, "u")
    if large:
        return hung.filter("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = hung.select(F.col("u"), F.col("m").alias("v"))
    return (
        hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
        .filter("u > v").distinct()
    )


def _settled(stars: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    if stars.groupBy("u").count().filter("count > 1").take(1):
        return False
    return not stars.select(F.col("v").alias("u")).distinct().join(stars, "u", "left_semi").take(1)


def _dealt(pairs: DataFrame, parts: int) -> DataFrame:
    """Edges in parts by both ends, so that a node with very many edges fills no part.

    A single part has one key: it stays whole also where more partitions are made.
    """
    key = F.xxhash64("a", "b")
    return pairs.repartition(parts, key if parts > 1 else key % 1)


def components(edges: DataFrame, part_edges: int = PART_EDGES) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its smallest node.

    In the star steps a node with very many neighbours is reduced to its smallest neighbour
    before the shuffle. The number of rounds grows with the logarithm of the longest chain.
    """
    pairs = stored(edges.select("a", "b").filter("a <> b").distinct())
    parts = pairs.count() // part_edges + 1
    current = stored(_dealt(pairs, parts).mapInArrow(_contract, _STAR))
    while parts > 1 and not _settled(current):
        current = stored(_stars(_stars(current, True), False))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
