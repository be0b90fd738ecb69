"""N-gram Jaccard join: documents whose word shingles overlap, exactly, and their groups.

A document is the set of its shingles in one global order. Two sets with the needed
overlap share a token among the first quarter or so of either (the prefix), so prefixes
are indexed: token -> sets, with set size and token position.

* Lists are kept in order of set size and cut into blocks. Pairs of blocks whose sizes, or
  whose tokens behind the position, cannot reach the needed overlap are skipped whole, and
  so are blocks that lie in one known group.
* A long list is not compared pair by pair. Its `PIVOTS` members of smallest hash are
  compared with all others first. What is known of a member against the first pivot then
  bounds its overlap with any other member: at most overlap(pivot, y) + |x| - overlap(pivot, x).
  Only pairs that are in different groups so far and that this bound admits are compared, block
  by block: a block's sets travel, each with its partners, never a row for each pair.
* Candidates are compared on their prefixes, which bounds the overlap from above, and those
  that remain on their full sets.

That finds the groups, and every link lies within one. A link that has not been compared by
then joins two members of long lists. `jaccard_join` returns all links: those compared, and
for members of long lists the sets of a group are cut into blocks by size and hash, and each pair of blocks that sizes
admit is one cell, in which all overlaps are counted on whole sets. Each pair of sets meets in
one cell only. Copies of a set are its multiplicity, not links of their own; `near_duplicates`
can count the links of each document without making a row for each link.

The global order puts tokens that very many sets share last, so they seldom are in a
prefix. It is estimated from the texts whose hash falls into one of `ORDER_SHARE` parts
and holds at most `ORDER_TOKENS` tokens. Any order gives the same result; this one only
saves work. The join itself covers all sets. Tokens and set ids are 64-bit hashes.

Defined results: null texts and texts without words have an empty set, are linked with
nothing (0 links) and are their own component. Fewer words than a shingle count as one shingle.
Repeated rows have equal sets and share a component, whose id is the smallest id that is
not null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import BitFilter, arrow_map, lists, stored
from subtally.llm.components import components
from subtally.llm.textblocks import BASE, Block, mix, text_blocks, window_hashes, words_of

SHINGLE_WORDS = 5
PERCENT = 75
ORDER_SHARE = 16
ORDER_TOKENS = 1 << 16
#: Texts of the order's share that hold a token before it counts as frequent.
FREQUENT = 4
#: Lists up to this length are compared at once, longer ones by way of their pivot.
SHORT_LIST = 16
#: Members of a long list that all others are compared with first.
PIVOTS = 6
#: Members of a block, and of a salted part of a very long list.
BLOCK_SETS = 1024
PART_SETS = 4096
#: Expected tokens of a block of a group, and columns of a matrix in which overlaps are counted.
LINK_TOKENS = 1 << 18
LINK_COLUMNS = 1 << 12
_U = np.uint64


def shingles(block: Block, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    words = words_of(block, fold=True)
    at, hashes = window_hashes(words, size)
    bounds = np.searchsorted(at, words.first)
    out = []
    for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if a < b:
            found = np.sort(hashes[a:b])
            keep = np.ones(len(found), bool)
            keep[1:] = found[1:] != found[:-1]
            out.append(found[keep])
        elif words.first[row] < words.first[row + 1]:
            own = words.hash[words.first[row] : words.first[row + 1]]
            whole = np.full(1, len(own), np.uint64)
            for i in range(len(own)):
                whole = mix(whole * BASE + own[i : i + 1])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _set_id(tokens: np.ndarray) -> int:
    total = mix(tokens ^ BASE).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ _U(len(tokens))]))[0].view(np.int64))


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of n and m tokens with 100 * overlap >= percent * union."""
    return -((-percent * (n + m)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


class _Order:
    """Tokens as keys of the global order: rare ones by hash, frequent ones last."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        rank = np.argsort(counts, kind="stable")
        order = np.argsort(tokens)
        place = np.empty(len(tokens), np.uint64)
        place[rank] = np.arange(len(tokens), dtype=np.uint64)
        self.tokens, self.place = tokens[order], place[order]
        self.parts = (counts[rank] * ORDER_SHARE) // PART_SETS + 1

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        keys = tokens >> _U(1)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            known = self.tokens[at] == tokens
            keys[known] = (_U(1) << _U(63)) | self.place[at[known]]
        keys.sort()
        return keys

    def parts_of(self, keys: np.ndarray) -> np.ndarray:
        """Into how many parts the list of each key is dealt."""
        parts = np.ones(len(keys), np.int64)
        known = keys >= _U(1) << _U(63)
        parts[known] = self.parts[(keys[known] & _U((1 << 32) - 1)).astype(np.int64)]
        return parts


def _order(documents: DataFrame, text: str, size: int) -> _Order:
    """A bounded sample gives the order of tokens; results do not depend on it."""

    def tokens(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column(0)):
            yield {"token": np.concatenate(shingles(block, size) or [np.empty(0, np.uint64)])}

    chosen = documents.select(F.col(text)).filter(F.pmod(F.xxhash64(text), F.lit(ORDER_SHARE)) == 0)
    counted = arrow_map(chosen, tokens, "token long").groupBy("token").count()
    top = counted.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "token")
    rows = top.limit(ORDER_TOKENS).collect()  # at most ORDER_TOKENS rows
    return _Order(
        np.array([r[0] for r in rows], np.int64).view(np.uint64),
        np.array([r[1] for r in rows], np.int64),
    )


def _pairs_in(list_no, sets, sizes, rest, percent, reach: int) -> np.ndarray:
    """Pairs of neighbours up to `reach` places apart in a list that can have the overlap."""
    found = []
    for step in range(1, reach + 1):
        i = np.flatnonzero(list_no[step:] == list_no[:-step])
        if not len(i):
            break
        j = i + step
        least = needed(sizes[i], sizes[j], percent)
        ok = (np.minimum(sizes[i], sizes[j]) >= least) & (np.minimum(rest[i], rest[j]) >= least)
        found.append(np.stack((sets[i[ok]], sets[j[ok]])))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


def _unique_pairs(pairs: np.ndarray) -> np.ndarray:
    pairs = np.sort(pairs, axis=0)
    pairs = pairs[:, np.lexsort(pairs)]
    keep = np.ones(pairs.shape[1], bool)
    keep[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    return pairs[:, keep]


_LIST_ROW = "a long, b long, token long, block long, sizes long, rest long"


def _search_lists(percent: int):
    """Candidate pairs of the lists in a partition, and the members of its long lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[np.asarray(c) for c in b.columns] for b in batches]
        if not held:
            return
        token, part, parts, sets, sizes, rest = (np.concatenate(c) for c in zip(*held))
        del held
        order = np.lexsort((sets, sizes, part, token))
        token, part, parts, sets, sizes, rest = (
            c[order] for c in (token, part, parts, sets, sizes, rest)
        )
        same = (token[1:] == token[:-1]) & (part[1:] == part[:-1])
        keep = np.ones(len(token), bool)
        keep[1:] = ~(same & (sets[1:] == sets[:-1]))  # copies of a set in several batches
        token, part, parts, sets, sizes, rest = (
            c[keep] for c in (token, part, parts, sets, sizes, rest)
        )
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(token)))
        list_no = np.repeat(np.arange(len(begin)), length)
        long = np.repeat((length > SHORT_LIST), length) | (parts > 1)
        short = ~long & np.repeat(length > 1, length)
        pairs = [_pairs_in(list_no[short], sets[short], sizes[short], rest[short], percent, SHORT_LIST)]
        members = np.flatnonzero(long)
        if len(members):
            first = np.flatnonzero(new[members])
            number = np.cumsum(new[members]) - 1
            size = np.diff(np.append(first, len(members)))
            by_spread = members[np.lexsort((mix(sets[members].view(np.uint64)), number))]
            for k in range(PIVOTS):
                pivot = by_spread[first + np.minimum(k, size - 1)][number]
                need = needed(sizes[members], sizes[pivot], percent)
                ok = np.minimum(sizes[members], sizes[pivot]) >= need
                ok &= np.minimum(rest[members], rest[pivot]) >= need
                ok &= sets[members] != sets[pivot]
                pairs.append(np.stack((sets[members[ok]], sets[pivot[ok]])))
            pivot = by_spread[first][number]
            block = (members - begin[list_no[members]]) // BLOCK_SETS + (part[members] << 32)
            yield _list_rows(sets[members], sets[pivot], token[members], block, sizes[members], rest[members])
        found = _unique_pairs(np.concatenate(pairs, axis=1))
        for at in range(0, found.shape[1], 100_000):
            a, b = found[:, at : at + 100_000]
            nothing = np.full(len(a), -1)
            yield _list_rows(a, b, nothing, nothing, nothing, nothing)

    return run


def _list_rows(*columns: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in _LIST_ROW.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _overlap(x: np.ndarray, y: np.ndarray, n: int, m: int) -> tuple[int, int]:
    """Least and greatest overlap of sets of n and m tokens whose first ones are x and y."""
    end = min(x[-1], y[-1])
    p, q = np.searchsorted(x, end, "right"), np.searchsorted(y, end, "right")
    both = np.sort(np.concatenate((x[:p], y[:q])))
    low = int((both[1:] == both[:-1]).sum())
    return low, low + min(n - p, m - q)


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int, whole: bool) -> DataFrame:
    """a, b, overlap at most and at least, of the pairs that can still be linked (or are)."""
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "t_a", "t_b")

    def measured(batch: pa.RecordBatch) -> Iterator[dict]:
        n, m = np.asarray(batch.column("n_a")), np.asarray(batch.column("n_b"))
        low, high = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for i, (x, y) in enumerate(zip(batch.column("t_a"), batch.column("t_b"))):
            x, y = (np.asarray(v.values).view(np.uint64) for v in (x, y))
            low[i], high[i] = _overlap(x, y, n[i], m[i])
        ok = low >= needed(n, m, percent) if whole else high >= needed(n, m, percent)
        yield {"a": np.asarray(batch.column("a")), "b": np.asarray(batch.column("b")),
               "low": low, "high": high, "linked": ok}

    return arrow_map(joined, measured, "a long, b long, low long, high long, linked boolean")


def _token_lists(column: pa.Array) -> list[np.ndarray]:
    flat = np.asarray(column.flatten()).view(np.uint64)
    return np.split(flat, np.cumsum(np.asarray(column.value_lengths()))[:-1])


def _one_per_set(rows: DataFrame) -> DataFrame:
    return rows.groupBy("set").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


class _Sets:
    """The sets of all documents, stored with their prefixes, and full sets on demand."""

    def __init__(self, documents: DataFrame, text: str, row_id: str, size: int, percent: int):
        self._spark, self._size, self._percent = documents.sparkSession, size, percent
        self._texts = documents.select(
            F.col(row_id).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
        )
        order = self.order = _order(documents, text, size)

        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            seen: set[int] = set()
            for block in text_blocks(batch.column("text")):
                keys = [order.keys(s) for s in shingles(block, size)]
                ids = [_set_id(k) if len(k) else None for k in keys]
                flat = [k[: prefix_length(len(k), percent)] if i not in seen and not seen.add(i) else k[:0]
                        for k, i in zip(keys, ids)]
                bounds = np.concatenate(([0], np.cumsum([len(k) for k in flat])))
                own = {c: batch.column(c).slice(block.row, block.rows) for c in ("doc", "text_hash")}
                yield own | {
                    "set": ids, "n": [len(k) for k in keys], "tokens": lists(np.concatenate(flat), bounds),
                }

        kinds = "doc long, text_hash long, set long, n long, tokens array<long>"
        self.rows = stored(arrow_map(self._texts, rows, kinds))
        self.prefixes = self.rows.filter(F.size("tokens") > 0)

    def postings(self) -> DataFrame:
        order = self.order

        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            tokens = batch.column("tokens")
            counts = np.asarray(tokens.value_lengths())
            key = np.asarray(tokens.flatten()).view(np.uint64)
            sets = np.repeat(np.asarray(batch.column("set")), counts)
            n = np.repeat(np.asarray(batch.column("n")), counts)
            place = np.arange(len(key)) - np.repeat(np.cumsum(counts) - counts, counts)
            parts = order.parts_of(key)
            part = (mix(sets.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            yield {"token": key, "part": part, "parts": parts, "set": sets, "n": n, "rest": n - place}

        frame = self.prefixes.select("set", "n", "tokens")
        return arrow_map(frame, rows, "token long, part int, parts int, set long, n int, rest int")

    def full(self, wanted: DataFrame) -> DataFrame:
        """Whole sets of the wanted ids (and of few others that the filter lets through)."""
        order, size = self.order, self._size
        chosen = BitFilter(self._spark, wanted.select("set"), "set")

        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            seen: set[int] = set()
            for block in text_blocks(batch.column("text")):
                keys = [order.keys(s) for s in shingles(block, size) if len(s)]
                ids = np.array([_set_id(k) for k in keys], np.int64)
                use = [i for i in np.flatnonzero(chosen.contains(ids)).tolist() if ids[i] not in seen]
                seen.update(ids[use].tolist())
                bounds = np.concatenate(([0], np.cumsum([len(keys[i]) for i in use]))).astype(np.int64)
                flat = np.concatenate([keys[i] for i in use]) if use else np.empty(0, np.uint64)
                yield {"set": ids[use], "n": np.diff(bounds), "tokens": lists(flat, bounds)}

        return arrow_map(self._texts.select("text"), rows, "set long, n long, tokens array<long>")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """a, b, low, high, linked of the candidate pairs, exact where `high` admits a link."""
        bounded = stored(_bounded(pairs, _one_per_set(self.prefixes), self._percent, False))
        admitted = bounded.filter("linked").select("a", "b")
        return stored(self.verified(admitted).unionByName(bounded.filter("NOT linked")))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The same on whole sets."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("set"))
        return _bounded(pairs, _one_per_set(self.full(wanted)), self._percent, True)


def _by_cell(handle: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """Hands over the rows of one cell at a time, of batches in which cells stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = np.asarray(batch.column("cell"))
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if held and held[0].column("cell")[0].as_py() != int(key[low]):
                    yield from handle(pa.Table.from_batches(held))
                    held = []
                if high > low:
                    held.append(batch.slice(low, high - low))
        if held:
            yield from handle(pa.Table.from_batches(held))

    return run


def _in_cells(rows: DataFrame, handle: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_by_cell(handle), schema)


_NEAR = ("cell", "side", "same", "token", "set", "n", "rest", "grp", "pivot", "low", "high")
_CANDIDATE = "cell long, set long, n long, grp long, partners array<long>"


def _cell_sides(cell: pa.Table) -> list[dict]:
    """Columns of the two blocks of a cell, or of the one that it holds against itself."""
    same, side = bool(cell["same"][0].as_py()), np.asarray(cell["side"])
    sides = []
    for k in (0,) if same else (0, 1):
        own = cell.filter(pa.array(side == k)).combine_chunks()
        if not len(own):
            return []
        columns = {c: np.asarray(own[c]) for c in own.column_names if c != "tokens"}
        if "tokens" in own.column_names:
            columns["tokens"] = _token_lists(own["tokens"].combine_chunks())
        sides.append(columns)
    return sides


def _admitted(p: dict, q: dict, at: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which sets of `q` the bounds admit with set `at` of `p`, and the overlap they need."""
    n = p["n"][at]
    least = needed(n, q["n"], percent)
    ok = (np.minimum(p["rest"][at], q["rest"]) >= least) & (p["grp"][at] != q["grp"])
    ok &= np.minimum(n, q["n"]) >= least
    shared = p["pivot"][at] == q["pivot"]
    ok &= ~shared | (q["high"] + n - p["low"][at] >= least)
    ok &= ~shared | (p["high"][at] + q["n"] - q["low"] >= least)
    if p is q:
        ok[: at + 1] = False
    return ok, least


def _cross_candidates(members: DataFrame, known: DataFrame, groups: DataFrame, prefixes: DataFrame,
                      percent: int) -> DataFrame:
    """Sets of long lists that may be linked with a set of another group, with these partners.

    `members`: set, pivot, token, block, n, rest; `known`: compared pairs; `groups`: set, grp;
    `prefixes`: set, tokens. Two blocks of a list (or one with itself) are a cell. A pair is
    looked at in the list of its first common token only, and both its sets have a row in that
    cell: there are as many rows as members of cells, not as pairs.
    """
    grouped = members.join(groups, "set", "left").withColumn("grp", F.coalesce("grp", "set"))
    mixed = grouped.groupBy("token").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).filter("x < y")
    left = grouped.join(mixed.select("token"), "token")
    facts = known.select(F.col("a").alias("set"), F.col("b").alias("pivot"), "low", "high").unionByName(
        known.select(F.col("b").alias("set"), F.col("a").alias("pivot"), "low", "high")
    )
    left = left.join(facts, ["set", "pivot"], "left")
    blocks = left.groupBy("token", "block").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"),
        F.max("rest").alias("rest_max"), F.min("grp").alias("grp_min"), F.max("grp").alias("grp_max"),
    )
    other = blocks.select("token", *[F.col(c).alias(f"{c}_2") for c in blocks.columns if c != "token"])
    smaller, larger = F.least("n_max", "n_max_2"), F.greatest("n_min", "n_min_2")
    least = F.ceil(percent * (F.col("n_min") + F.col("n_min_2")) / (100 + percent))
    reach = (
        (F.col("block") <= F.col("block_2"))
        & (100 * smaller >= percent * larger)
        & (F.least("rest_max", "rest_max_2") >= least)
        & ~((F.col("grp_min") == F.col("grp_max")) & (F.col("grp_min_2") == F.col("grp_max_2"))
            & (F.col("grp_min") == F.col("grp_min_2")))
    )
    reached = blocks.join(other, "token").filter(reach)
    same = F.col("block") == F.col("block_2")
    sides = reached.select(
        "token", F.xxhash64("token", "block", "block_2").alias("cell"), same.alias("same"),
        F.explode(F.when(same, F.array(F.struct("block", F.lit(0).alias("side")))).otherwise(F.array(
            F.struct("block", F.lit(0).alias("side")),
            F.struct(F.col("block_2").alias("block"), F.lit(1).alias("side"))))).alias("at"),
    ).select("token", "cell", "same", "at.block", "at.side")
    pivot = F.col("set") == F.col("pivot")
    placed = left.join(sides, ["token", "block"]).select(
        *_NEAR[:-2],
        F.when(pivot, F.col("n")).otherwise(F.coalesce("low", F.lit(0))).alias("low"),
        F.when(pivot, F.col("n")).otherwise(F.coalesce("high", "n")).alias("high"),
    )

    def near(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        """The rows of sets that the bounds admit with any other: few, and yet without tokens."""
        sides = _cell_sides(cell)
        if not sides:
            return
        p, q = sides[0], sides[-1]
        used = [np.zeros(len(side["set"]), bool) for side in sides]
        for at in range(len(p["set"])):
            ok, _ = _admitted(p, q, at, percent)
            used[0][at] |= ok.any()
            used[-1] |= ok
        for side, keep in zip(sides, used):
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(side[c][keep]) for c in _NEAR], list(_NEAR))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    rows = _in_cells(placed, near, kinds).join(prefixes.select("set", "tokens"), "set").select(*_NEAR, "tokens")

    def candidates(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        sides = _cell_sides(cell)
        if not sides:
            return
        token = np.asarray(cell["token"]).view(np.uint64)[0]
        for side in sides:
            side["before"] = [t[: np.searchsorted(t, token)] for t in side["tokens"]]
        p, q = sides[0], sides[-1]
        partners: dict[int, list[int]] = {}
        facts_of: dict[int, tuple[int, int]] = {}
        for at in range(len(p["set"])):
            ok, least = _admitted(p, q, at, percent)
            n, own = p["n"][at], int(p["set"][at])
            for j in np.flatnonzero(ok).tolist():
                if np.isin(p["before"][at], q["before"][j], assume_unique=True).any():
                    continue
                if _overlap(p["tokens"][at], q["tokens"][j], n, q["n"][j])[1] >= least[j]:
                    second = int(q["set"][j])
                    partners.setdefault(own, []).append(second)
                    partners.setdefault(second, [])
                    facts_of[own] = int(n), int(p["grp"][at])
                    facts_of[second] = int(q["n"][j]), int(q["grp"][j])
        if partners:
            sets = list(partners)
            yield pa.RecordBatch.from_arrays([
                pa.array([cell["cell"][0].as_py()] * len(sets), pa.int64()), pa.array(sets, pa.int64()),
                pa.array([facts_of[s][0] for s in sets], pa.int64()),
                pa.array([facts_of[s][1] for s in sets], pa.int64()),
                pa.array([partners[s] for s in sets], pa.list_(pa.int64())),
            ], ["cell", "set", "n", "grp", "partners"])

    return _in_cells(rows, candidates, _CANDIDATE)


def _cross_links(candidates: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """a, b: links among the candidates, as many as it takes to join the groups of each cell.

    Whole sets go to the cells of their candidates; two groups that a cell has joined are not
    compared there any more.
    """
    whole = _one_per_set(sets.full(candidates.select("set").distinct())).select("set", "tokens")

    def links(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        names = cell["set"].to_pylist()
        place = {s: i for i, s in enumerate(names)}
        tokens = _token_lists(cell["tokens"].combine_chunks())
        size, group = np.asarray(cell["n"]), cell["grp"].to_pylist()
        root = {g: g for g in group}

        def found(g: int) -> int:
            while root[g] != g:
                root[g] = g = root[root[g]]
            return g

        linked = []
        for i, others in enumerate(cell["partners"].to_pylist()):
            for j in map(place.__getitem__, others):
                x, y = found(group[i]), found(group[j])
                if x == y:
                    continue
                low, _ = _overlap(tokens[i], tokens[j], size[i], size[j])
                if low >= needed(size[i], size[j], percent):
                    root[x] = y
                    linked.append(sorted((names[i], names[j])))
        if linked:
            yield _batch("a long, b long", *np.array(linked, np.int64).T)

    return _in_cells(candidates.join(whole, "set"), links, "a long, b long")


def _merged(groups: DataFrame, late: DataFrame) -> DataFrame:
    """Groups after further links, which are links between whole groups."""
    ends = [groups.select(F.col("set").alias(x), F.col("grp").alias(f"g_{x}")) for x in ("a", "b")]
    between = late.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
        F.coalesce("g_a", "a").alias("a"), F.coalesce("g_b", "b").alias("b")
    )
    roots = components(between).withColumnsRenamed({"node": "old", "component": "root"})
    moved = groups.join(roots, groups["grp"] == roots["old"], "left").select(
        "set", F.coalesce("root", "grp").alias("grp")
    )
    fresh = roots.select(F.col("old").alias("set"), F.col("root").alias("grp"))
    return moved.unionByName(fresh).groupBy("set").agg(F.min("grp").alias("grp"))


def _groups(sets: _Sets, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """set, grp of all linked sets; a, b, low of the links compared; sets of the long lists.

    Links found across groups, by `_cross_links`, only tell the groups: both their sets are of
    long lists, whose links `_linked` finds in cells.
    """
    found = stored(
        sets.postings().repartition("token", "part").mapInArrow(_search_lists(percent), _LIST_ROW)
    )
    candidates = found.filter("block = -1").select("a", "b").distinct()
    members = found.filter("block <> -1").select(
        F.col("a").alias("set"), F.col("b").alias("pivot"), "token", "block",
        F.col("sizes").alias("n"), "rest",
    )
    known = sets.compared(candidates)
    linked = known.filter("linked").select("a", "b")
    groups = stored(components(linked).select(F.col("node").alias("set"), F.col("component").alias("grp")))
    cells = stored(_cross_candidates(members, known, groups, _one_per_set(sets.prefixes), percent))
    late = stored(_cross_links(cells, sets, percent).distinct())
    if late.take(1):
        groups = _merged(groups, late)
    compared = known.filter("linked").select("a", "b", "low")
    return groups, compared, members.select("set").distinct()


def _copies(sets: _Sets) -> DataFrame:
    return sets.rows.filter("n > 0").groupBy("set").agg(F.count("*").alias("copies"), F.first("n").alias("n"))


def _cells(sets: _Sets, members: DataFrame, percent: int) -> DataFrame:
    """cell, side, same, set, n, copies, tokens: pairs of blocks (or one block with itself)."""
    # Linked sets are at most one class apart.
    size_class = F.col("n") if percent >= 100 else F.floor(F.log("n") / np.log(100 / percent))
    totals = members.groupBy("grp").agg(F.sum("n").alias("total"))
    small = F.col("total") <= LINK_TOKENS
    classed = members.join(totals, "grp").withColumn("cls", F.when(small, F.lit(0)).otherwise(size_class).cast("long"))
    parts = classed.groupBy("grp", "cls").agg((F.floor(F.sum("n") / LINK_TOKENS) + 1).alias("parts"))
    placed = classed.join(parts, ["grp", "cls"]).withColumn("part", F.pmod(F.xxhash64("set"), "parts"))
    block = F.struct("cls", "part")
    blocks = parts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = blocks.select("grp", block.alias("x"))
    pairs = blocks.join(blocks.withColumnRenamed("x", "y"), "grp").filter("x <= y AND y.cls - x.cls <= 1")
    sides = pairs.select(
        "grp", F.xxhash64("grp", "x", "y").alias("cell"), (F.col("x") == F.col("y")).alias("same"),
        F.explode(F.array_distinct(F.array(F.struct(F.col("x").alias("b"), F.lit(0).alias("side")), F.struct(
            F.col("y").alias("b"), F.when(F.col("x") == F.col("y"), 0).otherwise(1).alias("side"))))).alias("at"),
    ).select("grp", "cell", "same", "at.side", F.col("at.b.cls").alias("cls"), F.col("at.b.part").alias("part"))
    whole = _one_per_set(sets.full(members)).select("set", "tokens")
    # Tokens are moved once by set and once by cell; where they go is found without them.
    cells = placed.join(sides, ["grp", "cls", "part"]).groupBy("set", "n", "copies").agg(
        F.collect_list(F.struct("cell", "side", "same")).alias("cells")
    )
    return cells.join(whole, "set").select(F.explode("cells").alias("at"), "set", "n", "copies", "tokens").select(
        "at.cell", "at.side", "at.same", "set", "n", "copies", "tokens"
    )


def _overlaps(first: list[np.ndarray], second: list[np.ndarray] | None) -> np.ndarray:
    """Overlap of each set of `first` with each of `second` (or of `first` itself)."""
    sides = [first] if second is None else [first, second]
    found = []
    for side in sides:
        tokens, count = np.unique(np.concatenate(side), return_counts=True)
        found.append(tokens[count > 1] if second is None else tokens)
    common = found[0] if second is None else np.intersect1d(*found, assume_unique=True)
    places = []
    for side in sides:
        row = np.repeat(np.arange(len(side)), [len(x) for x in side])
        flat = np.concatenate(side)
        at = np.searchsorted(common, flat)
        ok = at < len(common)
        ok[ok] = common[at[ok]] == flat[ok]
        places.append((row[ok], at[ok]))
    total = np.zeros((len(first), len(sides[-1])), np.float32)
    for low in range(0, len(common), LINK_COLUMNS):
        held = []
        for side, (row, at) in zip(sides, places):
            here = (at >= low) & (at < low + LINK_COLUMNS)
            matrix = np.zeros((len(side), min(LINK_COLUMNS, len(common) - low)), np.float32)
            matrix[row[here], at[here] - low] = 1
            held.append(matrix)
        total += held[0] @ held[-1].T
    return total.astype(np.int64)  # sets of fewer than 2**24 tokens are counted exactly


def _cell_links(percent: int, rows: bool):
    """Links of a cell: a row for each, or their number for each set."""

    def links(cell: pa.Table) -> Iterator[pa.RecordBatch]:
        sides = _cell_sides(cell)
        if not sides:
            return
        p, q = sides[0], sides[-1]
        same = p is q
        both = _overlaps(p["tokens"], None if same else q["tokens"])
        linked = both >= needed(p["n"][:, None], q["n"][None, :], percent)
        if rows:
            if same:
                linked = np.triu(linked, 1)
            for at in range(0, len(p["set"]), 64):  # bounded batches
                i, j = np.nonzero(linked[at : at + 64])
                i += at
                swap = p["set"][i] > q["set"][j]
                columns = [np.where(swap, y, x) for c in ("set", "n", "copies")
                           for x, y in ((p[c][i], q[c][j]), (q[c][j], p[c][i]))]
                yield _batch(_LINK, *columns, both[i, j])
            return
        if same:
            np.fill_diagonal(linked, False)
        yield _batch(_COUNT, p["set"], linked @ q["copies"])
        if not same:
            yield _batch(_COUNT, q["set"], linked.T @ p["copies"])

    return links


_LINK = "a long, b long, n_a long, n_b long, copies_a long, copies_b long, overlap long"
_COUNT = "set long, links long"


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _linked(sets: _Sets, found: tuple[DataFrame, DataFrame, DataFrame], percent: int, rows: bool) -> DataFrame:
    """A row for each link, or the number of links of each set (in parts)."""
    groups, compared, long = found
    copies = _copies(sets)
    members = stored(groups.join(long, "set", "left_semi").join(copies, "set"))
    # A group with one member of long lists has no pairs of them.
    several = members.groupBy("grp").count().filter("count > 1").select("grp")
    members = stored(members.join(several, "grp", "left_semi"))
    late = _in_cells(_cells(sets, members, percent), _cell_links(percent, rows), _LINK if rows else _COUNT)
    # Two ends among the members were counted in a cell.
    ends = [members.select(F.col("set").alias(x), F.lit(True).alias(f"in_{x}")) for x in ("a", "b")]
    early = compared.join(ends[0], "a", "left").join(ends[1], "b", "left")
    early = early.filter("in_a IS NULL OR in_b IS NULL")
    for x in ("a", "b"):
        early = early.join(copies.select(
            F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("copies").alias(f"copies_{x}")), x)
    if rows:
        return late.unionByName(early.withColumn("overlap", F.col("low")).select(*late.columns))
    return late.unionByName(early.select("a", "b", "copies_a", "copies_b").select(F.explode(F.array(
        F.struct(F.col("a").alias("set"), F.col("copies_b").alias("links")),
        F.struct(F.col("b").alias("set"), F.col("copies_a").alias("links")))).alias("x")).select("x.*"))


def jaccard_join(documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT,
                 text: str = "text", row_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and the documents of the sets.

    Links: a < b, sizes, copies (documents) of both sets, overlap. Documents: id, text hash,
    set (null without words).
    """
    sets = _Sets(documents, text, row_id, size, percent)
    links = _linked(sets, _groups(sets, percent), percent, True)
    return links, sets.rows.select(F.col("doc").alias(row_id), "text_hash", "set")


def near_duplicates(documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT,
                    text: str = "text", row_id: str = "doc_id", count_links: bool = False) -> DataFrame:
    """One row per document: its id and text hash, `n_shingles` and `component_id`.

    With `count_links` also `n_links`, the number of other documents it is linked with.
    """
    sets = _Sets(documents, text, row_id, size, percent)
    linked = _groups(sets, percent)
    groups = linked[0]
    rows = sets.rows.select("doc", "text_hash", "set", "n").join(groups, "set", "left")
    rows = rows.withColumn("grp", F.coalesce("grp", "set"))
    smallest = rows.filter("grp IS NOT NULL").groupBy("grp").agg(F.min("doc").alias("least"))
    columns = [
        F.col("doc").alias(row_id), "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"),
    ]
    if count_links:
        copies = _copies(sets).select("set", (F.col("copies") - 1).alias("links"))
        links = _linked(sets, linked, percent, False).unionByName(copies)
        rows = rows.join(links.groupBy("set").agg(F.sum("links").alias("n_links")), "set", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.join(smallest, "grp", "left").select(*columns)
