"""Hard negatives from rotated one-bit codes with deterministic intervals.

Every vector is turned by a fixed rotation (random signs and Walsh-Hadamard transforms). Its
code keeps one bit a component, the sign; with it are stored the norm of the vector and its
alignment, the length of its part along the code. An anchor is turned alike and quantised to a
few bits a component, so that its product with a code is a few population counts. What this
leaves unknown is bounded, not guessed: the rest of the vector is at right angles to the code,
so by Cauchy-Schwarz its product with the anchor is at most the length of the rest times the
length of the anchor's part beside the code; the error of the quantised anchor is known too.
Every pair thus gets an interval that holds its product for certain. Pairs whose interval
cannot reach the answer are dropped, all others are scored in integers: results are exact.

First the best rows of the anchor's own label, its positives; then, for each positive, the
best rows of other labels whose score lies in a band below the positive's. Rows and anchors are
dealt to blocks by hash, and each block of anchors meets each block of rows in one group of
bounded size, in which the k-th best score so far tightens what an interval has to reach. A
block returns at most k rows for an anchor (and positive), so the last windows are small.

Defined results: rows with a null id, label or vector, or a null or non-finite component take
no part; without any there is no result. An anchor's own row is no candidate for it, another
row of the same id is. Repeated rows are rows of their own, and repeated anchors give repeated
results. Only vectors of one length are compared. Ties go to the smaller id. A positive of
negative score has no band and no negatives. Products have to fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from subtally.llm.common import arrow_map, stored
from subtally.llm.textblocks import mix

#: Expected rows and anchors of a block.
ROW_BLOCK = 2048
ANCHOR_BLOCK = 1024
#: Rows that get their intervals at once.
_CHUNK = 256
#: Bits of an anchor's component.
ANCHOR_BITS = 4
_ROUNDS = 3
#: Room for rounding, relative to the product of both norms.
_SLACK = 1e-9


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by the fixed rotation, padded with zeros to a power of two from 64 on."""
    n, dim = vectors.shape
    size = max(64, 1 << (max(dim, 1) - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :dim] = vectors
    for turn in range(_ROUNDS):
        places = np.arange(size, dtype=np.uint64) + np.uint64(turn << 32)
        x *= np.where(mix(places + np.uint64(1)) >> np.uint64(63), 1.0, -1.0)
        half = 1
        while half < size:
            pairs = x.reshape(n, size // (2 * half), 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
            half *= 2
        x /= np.sqrt(size)
    return x


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class Intervals:
    """Certain bounds of the products of some anchors with coded rows."""

    def __init__(self, anchors: np.ndarray):
        turned = rotated(anchors)
        self.size = turned.shape[1]
        self.norm = np.sqrt((anchors**2).sum(axis=1))
        self.low = turned.min(axis=1)
        top = (1 << ANCHOR_BITS) - 1
        self.step = (turned.max(axis=1) - self.low) / top
        step = np.where(self.step > 0, self.step, 1.0)
        level = np.clip(np.rint((turned - self.low[:, None]) / step[:, None]), 0, top).astype(np.int64)
        self.planes = [packed((level >> b) & 1 > 0) for b in range(ANCHOR_BITS)]
        self.levels = level.sum(axis=1)
        off = turned - (self.low[:, None] + self.step[:, None] * level)
        self.error = np.sqrt((off**2).sum(axis=1))

    def bounds(self, codes: np.ndarray, norm: np.ndarray, align: np.ndarray):
        """Lowest and highest possible product of each anchor with each row."""
        counts = np.zeros((len(self.norm), len(codes)))
        for word in range(codes.shape[1]):
            for b, plane in enumerate(self.planes):
                shared = np.bitwise_count(plane[:, word, None] & codes[None, :, word])
                counts += shared.astype(np.float64) * (1 << b)
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        along = self.low[:, None] * (2 * ones - self.size)[None]
        along += self.step[:, None] * (2 * counts - self.levels[:, None])
        along /= np.sqrt(self.size)
        slack = _SLACK * self.norm[:, None] * norm[None]
        rest = np.sqrt(np.maximum(norm**2 - align**2, 0))
        reach = self.norm[:, None]
        least = np.clip(along - self.error[:, None], -reach, reach)
        most = np.clip(along + self.error[:, None], -reach, reach)
        # Of all products along the code that are possible, the one with the widest rest.
        turn = reach * np.divide(align, norm, out=np.zeros_like(norm), where=norm > 0)[None]

        def bound(at: np.ndarray, sign: int) -> np.ndarray:
            beside = np.sqrt(np.maximum(reach**2 - at**2, 0))
            return align[None] * at + sign * (rest[None] * beside + slack)

        return bound(np.clip(-turn, least, most), -1), bound(np.clip(turn, least, most), 1)


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten()).reshape(len(values), -1)


def _coded(integers: DataFrame) -> DataFrame:
    """Rows with their code, norm and alignment."""

    def code(batch: pa.RecordBatch) -> Iterator[dict]:
        lengths = np.asarray(batch.column("v").value_lengths())
        for dim in np.unique(lengths).tolist():
            part = batch.take(pa.array(np.flatnonzero(lengths == dim)))
            vectors = _matrix(part.column("v")).astype(float)
            turned = rotated(vectors)
            words = packed(turned > 0)
            yield {
                **{name: part.column(name) for name in ("row", "vec_id", "label", "v")},
                "dim": np.full(len(part), dim), "code": [w.tobytes() for w in words],
                "norm": np.sqrt((vectors**2).sum(axis=1)),
                "align": np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1]),
            }

    return arrow_map(
        integers, code,
        "row long, vec_id long, label long, v array<long>, dim int, code binary, norm double, align double",
    )


class Best:
    """The k best (score, id) of each group so far, by falling score and rising id."""

    def __init__(self, k: int):
        self.k = k
        self.group, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        group, score, row_id = (
            np.concatenate(both) for both in ((self.group, group), (self.score, score), (self.id, row_id))
        )
        order = np.lexsort((row_id, -score, group))
        group = group[order]
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        kept = order[rank < self.k]
        self.group, self.score, self.id = group[rank < self.k], score[kept], row_id[kept]

    def kth(self, groups: int, otherwise: np.ndarray) -> np.ndarray:
        """The k-th score of each group, or another value where there are fewer."""
        out = otherwise.copy()
        last = np.searchsorted(self.group, np.arange(groups), "right") - 1
        full = np.flatnonzero(np.bincount(self.group, minlength=groups) == self.k)
        out[full] = self.score[last[full]]
        return out


class _Block:
    """A block of anchors beside a block of rows."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.vectors, self.anchors = _matrix(rows.column("v")), _matrix(anchors.column("v"))
        most = [max(int(np.abs(m).max(initial=0)), 1) for m in (self.vectors, self.anchors)]
        if most[0] * most[1] * max(self.anchors.shape[1], 1) < 1 << 53:  # exact, and faster
            self.vectors, self.anchors = self.vectors.astype(float), self.anchors.astype(float)
        column = lambda t, name: t.column(name).to_numpy()
        self.label, self.anchor_label = column(rows, "label"), column(anchors, "label")
        self.row, self.anchor_row = column(rows, "row"), column(anchors, "row")
        self.id = column(rows, "vec_id")
        self.norm, self.align = column(rows, "norm"), column(rows, "align")
        codes = b"".join(rows.column("code").to_pylist())
        self.codes = np.frombuffer(codes, np.uint64).reshape(rows.num_rows, -1)
        self.intervals = Intervals(_matrix(anchors.column("v")).astype(float))

    def chunks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Row slices with the bounds of their products and whether labels agree."""
        for begin in range(0, len(self.id), _CHUNK):
            part = slice(begin, begin + _CHUNK)
            low, high = self.intervals.bounds(self.codes[part], self.norm[part], self.align[part])
            yield part, low, high, self.anchor_label[:, None] == self.label[None, part]

    def scores(self, part: slice, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and integer product of the needed pairs of a chunk."""
        anchor, row = np.nonzero(needed)
        vectors = self.vectors[part]
        if 8 * len(anchor) > needed.size:
            product = (self.anchors @ vectors.T)[anchor, row]
        else:
            product = np.einsum("ij,ij->i", self.anchors[anchor], vectors[row])
        return anchor, row + part.start, product.astype(np.int64)


def block_positives(block: _Block, k: int) -> Best:
    """Best other rows of the anchors' labels; groups are anchors."""
    best = Best(k)
    reach = np.full(len(block.anchor_row), -np.inf)
    for part, _, high, same in block.chunks():
        needed = same & (high >= reach[:, None])
        needed &= block.anchor_row[:, None] != block.row[None, part]
        anchor, row, product = block.scores(part, needed)
        best.add(anchor, product, block.id[row])
        reach = best.kth(len(reach), reach)
    return best


def block_negatives(block: _Block, scores: np.ndarray, known: np.ndarray, k: int, low: int, high: int) -> Best:
    """Best rows of other labels in the band of each positive; groups are anchor * positives + place."""
    n, places = scores.shape
    floor = np.where(known, -((-low * scores) // 100), 0)
    ceiling = np.where(known, (high * scores) // 100, 0)
    best = Best(k)
    reach = np.where(known & (floor <= ceiling), floor.astype(float), np.inf).ravel()
    for part, least, most, same in block.chunks():
        needed = np.zeros(same.shape, bool)
        for place in range(places):
            band = most >= reach.reshape(n, places)[:, place, None]
            needed |= band & (least <= ceiling[:, place, None])
        anchor, row, product = block.scores(part, needed & ~same)
        for place in range(places):
            fits = (product >= reach.reshape(n, places)[anchor, place]) & (product <= ceiling[anchor, place])
            best.add(anchor[fits] * places + place, product[fits], block.id[row[fits]])
        reach = best.kth(n * places, reach)
    return best


def _blocks(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int):
    """Every block of anchors beside every block of rows, as cogroups of (dim, both blocks)."""
    keys = ["dim", "anchor_block", "row_block"]
    to_all = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("anchor_block", F.pmod(F.xxhash64("row"), F.lit(anchor_blocks)).cast("int"))
    right = rows.withColumn("row_block", F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int"))
    left = left.withColumn("row_block", to_all(row_blocks))
    right = right.withColumn("anchor_block", to_all(anchor_blocks))
    left = left.toDF(*left.columns)  # columns of its own, told apart from those of `rows`
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


_FOUND = "anchor_row long, anchor_id long, place int, vec_id long, score long"


def _found(anchors: pa.Table, best: Best, places: int, target: pa.Schema) -> pa.Table:
    anchor = best.group // places
    columns = [
        anchors.column("row").to_numpy()[anchor], anchors.column("vec_id").to_numpy()[anchor],
        best.group % places, best.id, best.score,
    ]
    return pa.table([pa.array(c).cast(f.type) for c, f in zip(columns, target)], schema=target)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
    high: int = 100, scale: int = 256, row_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (`is_anchor` is a condition on `vec_id`) and each of its best `positives`
    rows of the same label, the best `negatives` rows of other labels whose score is `low` to
    `high` per cent of the positive's.
    """
    as_double = F.col(vector).cast("array<double>")
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    integers = (
        vectors.select(F.col(row_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                       as_double.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound)
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    )
    rows = stored(_coded(integers))  # the row numbers are what was written
    anchors = rows.filter(is_anchor)
    blocks = (max(1, -(-anchors.count() // ANCHOR_BLOCK)), max(1, -(-rows.count() // ROW_BLOCK)))
    target = to_arrow_schema(StructType.fromDDL(_FOUND))
    nothing = target.empty_table()

    def best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        return _found(left, block_positives(_Block(left, right), positives), 1, target)

    alike = _blocks(anchors, rows, *blocks).applyInArrow(best_positives, _FOUND)
    chosen = stored(_ranked(alike, ["anchor_row"], positives))
    by_anchor = chosen.groupBy(F.col("anchor_row").alias("row")).agg(  # at most `positives` rows
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("scores")
    )

    def best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        scores = np.zeros((left.num_rows, positives), np.int64)
        known = np.zeros(scores.shape, bool)
        for i, held in enumerate(left.column("scores").to_pylist()):
            scores[i, : len(held)], known[i, : len(held)] = held, True
        best = block_negatives(_Block(left, right), scores, known, negatives, low, high)
        return _found(left, best, positives, target)

    others = _blocks(anchors.join(by_anchor, "row"), rows, *blocks).applyInArrow(best_negatives, _FOUND)
    ranked = _ranked(others, ["anchor_row", "place"], negatives)
    pairs = chosen.select(
        "anchor_row", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return ranked.join(pairs, ["anchor_row", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
