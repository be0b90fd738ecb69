"""Exact top-k search by inner product in an M-tree of paged metric nodes.

Inner products become distances: with M the largest norm, a vector x gets one more
component sqrt(M*M - |x|^2) and a query q gets 0, and then |q - x|^2 = |q|^2 + M^2 - 2 q.x,
so the nearest vectors are those of largest product.

The tree has routing nodes, chosen from at most `NODES` vectors by the hash of their id;
every vector hangs below its nearest one. A node's vectors are dealt over pages of bounded
expected size. Each page stores its covering radius and each entry its distance to the
node. Search is best-first in two steps: a query first reads a page of its nearest node,
which bounds the distance of its k-th answer; then it reads only pages whose distance to
the query, less their radius, is within that bound, and in them computes only entries whose
stored distance to the node differs from the query's by no more than the bound. Bounds have
a small slack for rounding, scores are computed in integers, so results are exact. Queries
visit a page in blocks.

Where the vectors have no groups, few pages can be skipped and the search reads nearly all;
that is the nature of exact search in many dimensions.

Defined results: vectors that are null or hold null or non-finite components take no part,
neither as query nor as candidate; without any there is no result. Rows of equal id and
vector are one row, and rows of the query's own id are no candidates for it. Vectors of
another length than the query's are not compared. Ties go to the smaller id. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import arrow_map, stored

#: Most routing nodes per vector length; all tasks hold them.
NODES = 64
#: Expected entries of a page, and queries that visit a page at once.
PAGE_ENTRIES = 2048
QUERY_BLOCK = 256
SCALE = 256
_SLACK = 1e-6


def scaled(vectors: DataFrame, row_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector as integers, floor(scale * x), of the rows that take part."""
    as_double = F.col(vector).cast("array<double>")
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(row_id).cast("long").alias("vec_id"), as_double.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
        .distinct()
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal length."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.asarray(batch.column(column).value_lengths())
    for dim in np.unique(lengths).tolist():
        yield dim, np.flatnonzero(lengths == dim)


class Routing:
    """Routing vectors and norm bounds of each vector length."""

    def __init__(self, nodes: dict[int, np.ndarray], largest: dict[int, float]):
        self.nodes, self.largest = nodes, largest

    def distances(self, dim: int, v: np.ndarray, query: bool) -> np.ndarray:
        """Distance of each row of v to each routing vector, in the lifted space."""
        nodes = self.nodes[dim].astype(float)
        v = v.astype(float)
        norm, node_norm = (v**2).sum(axis=1), (nodes**2).sum(axis=1)
        last = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.largest[dim] - norm, 0))
        node_last = np.sqrt(np.maximum(self.largest[dim] - node_norm, 0))
        square = norm[:, None] + node_norm[None] - 2 * v @ nodes.T + (last[:, None] - node_last[None]) ** 2
        return np.sqrt(np.maximum(square, 0))


def _routing(vectors: DataFrame) -> Routing:
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    largest = vectors.groupBy(F.size("v").alias("dim")).agg(F.max(norm).alias("m")).collect()
    nodes = {}
    for dim, _ in largest:
        chosen = vectors.filter(F.size("v") == dim).orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(NODES)
        nodes[dim] = np.array([r.v for r in chosen.collect()], np.int64).reshape(-1, dim)
    return Routing(nodes, {dim: m for dim, m in largest})


def _pages(vectors: DataFrame, routing) -> DataFrame:
    """dim, node, page, radius, and the entries of each page in flat arrays."""

    def hang(batch: pa.RecordBatch) -> Iterator[dict]:
        for dim, at in _by_length(batch, "v"):
            part = batch.take(pa.array(at))
            away = routing.value.distances(dim, _matrix(part.column("v")), False)
            node = away.argmin(axis=1)
            yield {"dim": np.full(len(at), dim), "node": node, "away": away[np.arange(len(at)), node],
                   "vec_id": part.column("vec_id"), "v": part.column("v")}

    hung = arrow_map(vectors, hang, "dim int, node int, away double, vec_id long, v array<long>")
    sizes = hung.groupBy("dim", "node").agg((F.ceil(F.count("*") / PAGE_ENTRIES)).alias("pages"))
    page = F.pmod(F.xxhash64("vec_id", "v"), F.col("pages")).alias("page")
    entries = hung.join(sizes, ["dim", "node"]).select("dim", "node", page, "away", "vec_id", "v")
    return entries.groupBy("dim", "node", "page").agg(  # about PAGE_ENTRIES entries
        F.max("away").alias("radius"), F.min("away").alias("inner"),
        F.collect_list(F.struct("away", "vec_id", "v")).alias("entries"),
    )


def _visit(visits: DataFrame, pages: DataFrame, k: int) -> DataFrame:
    """Best k entries of each visited page for each query: query_id, q, vec_id, score."""
    block = F.pmod(F.col("q"), F.greatest(F.ceil(F.col("n") / QUERY_BLOCK), F.lit(1)))
    counts = visits.groupBy("dim", "node", "page").agg(F.count("*").alias("n"))
    blocks = visits.join(counts, ["dim", "node", "page"]).groupBy("dim", "node", "page", block.alias("block")).agg(
        F.collect_list(F.struct("query_id", "q", "v", "to_node", "bound")).alias("queries")
    )
    both = blocks.join(pages.select("dim", "node", "page", "entries"), ["dim", "node", "page"])

    def best(batch: pa.RecordBatch) -> Iterator[dict]:
        for dim, queries, entries in zip(*(batch.column(c) for c in ("dim", "queries", "entries"))):
            q, e = queries.values, entries.values
            ids, qv = np.asarray(e.field("vec_id")), _matrix(q.field("v"))
            away, to_node = np.asarray(e.field("away")), np.asarray(q.field("to_node"))
            bound, query = np.asarray(q.field("bound")), np.asarray(q.field("query_id"))
            order = np.argsort(away)
            away, ids, ev = away[order], ids[order], _matrix(e.field("v"))[order]
            # The stored distances leave a stretch of entries for each query.
            low = np.searchsorted(away, to_node - bound, "left")
            high = np.searchsorted(away, to_node + bound, "right")
            exact = max(int(np.abs(qv).max(initial=0)), 1) * max(int(np.abs(ev).max(initial=0)), 1) * max(dim.as_py(), 1) < 2**53
            left, right = (qv.astype(float), ev.astype(float)) if exact else (qv, ev)
            rows, places, scores = [], [], []
            for i in range(len(query)):
                near = np.arange(low[i], high[i])
                near = near[ids[near] != query[i]]
                score = (right[near] @ left[i]).astype(np.int64)
                top = np.lexsort((ids[near], -score))[:k]
                rows += [i] * len(top)
                places.append(ids[near][top])
                scores.append(score[top])
            if rows:
                yield {"query_id": query[rows], "q": np.asarray(q.field("q"))[rows],
                       "vec_id": np.concatenate(places), "score": np.concatenate(scores)}

    return arrow_map(both, best, "query_id long, q long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query, k: int = 5, row_id: str = "vec_id",
           vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query.

    `is_query` is a condition on the column `vec_id`.
    """
    spark = vectors.sparkSession
    integers = stored(scaled(vectors, row_id, vector, scale))
    routing = spark.sparkContext.broadcast(_routing(integers))  # at most NODES vectors per length
    pages = stored(_pages(integers, routing))
    # Rows of one id may differ in their vector: `q` tells them apart.
    queries = integers.filter(is_query).withColumn("q", F.xxhash64("vec_id", "v"))

    def route(batch: pa.RecordBatch) -> Iterator[dict]:
        for dim, at in _by_length(batch, "v"):
            part = batch.take(pa.array(at))
            away = routing.value.distances(dim, _matrix(part.column("v")), True)
            n = away.shape[1]
            order = away.argsort(axis=1).ravel()
            row = np.repeat(np.arange(len(at)), n)
            yield {"query_id": part.column("vec_id").take(pa.array(row)), "q": part.column("q").take(pa.array(row)),
                   "v": part.column("v").take(pa.array(row)), "dim": np.full(len(row), dim), "node": order, "to_node": away[row, order],
                   "place": np.tile(np.arange(n), len(at))}

    routed = arrow_map(
        queries, route, "query_id long, q long, v array<long>, dim int, node int, to_node double, place int"
    )
    unbounded = F.lit(float("inf")).alias("bound")
    nearest = routed.filter("place = 0").select("query_id", "q", "v", "dim", "node", "to_node", unbounded)
    directory = pages.select("dim", "node", "page", "radius", "inner")
    first_visits = nearest.join(directory.groupBy("dim", "node").agg(F.min("page").alias("page")), ["dim", "node"])
    first = stored(_ranked(_visit(first_visits, pages, k), k))
    # Squared distance of the k-th answer so far: |q|^2 + M^2 - 2 * score.
    largest = spark.createDataFrame(
        pa.table({"dim": pa.array(list(routing.value.largest), pa.int32()),
                  "m": pa.array(list(routing.value.largest.values()), pa.float64())})
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    kth = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "q", F.col("score").alias("kth"))
    slack = _SLACK * (1 + F.sqrt(F.col("m")) + F.sqrt(square))
    distance = F.sqrt(F.greatest(square + F.col("m") - 2 * F.col("kth"), F.lit(0.0)))
    # A first page of fewer than k entries gives no bound.
    bound = F.when(F.col("kth").isNotNull(), distance + slack).otherwise(float("inf"))
    bounded = (
        queries.withColumn("dim", F.size("v")).join(largest, "dim")
        .join(kth, ["vec_id", "q"], "left")
        .select(F.col("vec_id").alias("query_id"), "q", bound.alias("bound"))
    )
    visits = (
        routed.join(bounded, ["query_id", "q"])
        .join(directory, ["dim", "node"])
        .filter((F.col("to_node") - F.col("radius") <= F.col("bound"))
                & (F.col("inner") - F.col("to_node") <= F.col("bound")))
        .select("query_id", "q", "v", "dim", "node", "page", "to_node", "bound")
    )
    return _ranked(_visit(visits, pages, k), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
