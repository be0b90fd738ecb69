"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere go.

1. Every string of `length` bytes is represented by its smallest-hashed `seed`-byte piece,
   its anchor. Equal strings have equal anchors, so strings whose anchor occurs once in
   the corpus are unique. So are those whose anchor occurs but once together with half of
   the other bytes on the side where the string has more of them. Neighbouring strings with
   equal anchors that are left form one context.
2. Contexts are counted by hash. Equal ones settle each other; the bytes of the different
   contexts of an anchor, equal ones combined, meet in a block of bounded expected size.
3. In each block the suffixes are sorted and their Burrows-Wheeler transform is taken.
   Common prefixes are derived by increasing value: boundaries between suffixes that differ
   in their first letter have value 0, and backward extension by one letter carries the
   boundaries of value v over to those of value v + 1. The expansion stops at `length`:
   neighbours without a boundary by then share at least `length` bytes.
4. An anchor with more than `BLOCK_CONTEXTS` different contexts, or more bytes of them than
   a block, is not put into a block; its strings are counted by hash, with partial counts
   before the shuffle.

What is known of the anchors (which occur twice or more, which have several contexts or very
many) reaches the tasks as bit filters of fixed size. A filter that lets too much through
costs work but changes no result. Texts equal as a whole are found by digest and lose all their bytes.
Anchors and contexts are compared by 64-bit hashes, two for each context.

Defined results: null and empty texts have 0 bytes and nothing is removed. Each row is a
document of its own, so repeated rows of enough length remove each other; null ids are
kept. Extra columns are carried along, result columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import BitFilter, arrow_map, stored, unused
from subtally.llm.textblocks import _BYTE_VALUES, Block, covered_ranges, mix, prefix_sums, text_blocks

MIN_BYTES = 400
SEED_BYTES = 128
#: Different contexts of one anchor that may share a block, and bytes that a block aims at.
BLOCK_CONTEXTS = 512
BLOCK_BYTES = 3 << 17


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values the place of its leftmost minimum."""
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    place = np.arange(rows * width).reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1)
    fresh = np.ones(grid.shape, bool)
    fresh[:, 1:] = grid[:, 1:] < ahead[:, :-1]
    ahead_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)
    fresh[:, 1:] = grid[:, ::-1][:, 1:] <= back[:, :-1]
    fresh[:, 0] = True
    back_at = np.minimum.accumulate(np.where(fresh, place[:, ::-1], rows * width), axis=1)[:, ::-1].ravel()
    first = np.arange(n - width + 1)
    a, b = back_at[first], ahead_at[first + width - 1]
    return np.where(padded[a] <= padded[b], a, b)


class _Strings:
    """All strings of `length` bytes of a block's texts with their anchors."""

    def __init__(self, block: Block, length: int, seed: int):
        self.length, self.sums = length, None
        sizes = np.diff(block.offsets)
        rooms = np.maximum(sizes - length + 1, 0)
        text = np.repeat(np.arange(block.rows), rooms)
        place = np.arange(len(text)) - np.repeat(np.cumsum(rooms) - rooms, rooms)
        self.start, self.text = block.offsets[text] + place, text
        if len(text):
            self.sums, self.scale = prefix_sums(_BYTE_VALUES[block.data])
            n = len(block.data) - seed + 1
            seeds = mix((self.sums[seed:] - self.sums[:-seed]) * self.scale[:n])
            self.anchor = leftmost_minima(seeds, length - seed + 1)[self.start]
            self.hash = seeds[self.anchor]
            self._keys(length - seed, seed)
        else:
            self.anchor, self.hash = self.start, np.empty(0, np.uint64)
            self.new, self.key = np.empty(0, bool), self.hash

    def _keys(self, room: int, seed: int) -> None:
        """Of each string the hash of its anchor and, to its longer side, half of the rest."""
        left = room // 2
        before = self.anchor - self.start >= left
        self.new = new = np.ones(len(before), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (before[1:] != before[:-1])
        at = np.flatnonzero(new)
        anchor, before = self.anchor[at], before[at]
        begin = np.where(before, anchor - left, anchor)
        end = np.where(before, anchor, anchor + room - left) + seed
        key = mix(mix((self.sums[end] - self.sums[begin]) * self.scale[begin]) ^ before.astype(np.uint64))
        self.key = np.repeat(key, np.diff(np.append(at, len(new))))

    def contexts(self, chosen: np.ndarray) -> dict[str, np.ndarray]:
        """Runs of neighbouring chosen strings with equal anchors.

        `inner` tells whether the anchor occurs more than once, as in periodic text; only
        then can a run repeat a string of its own.
        """
        at = np.flatnonzero(chosen)
        new = np.ones(len(at), bool)
        new[1:] = (
            (self.start[at[1:]] != self.start[at[:-1]] + 1)
            | (self.hash[at[1:]] != self.hash[at[:-1]])
            | (self.text[at[1:]] != self.text[at[:-1]])
        )
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        begin, end = self.start[first], self.start[last] + self.length
        inner = self.anchor[first] != self.anchor[last]
        if not len(at):
            content = np.empty(0, np.uint64)
        else:
            content = mix((self.sums[end] - self.sums[begin]) * self.scale[begin])
            shape = (end - begin).astype(np.uint64) << np.uint64(32)
            content = mix(content ^ mix(shape | (self.anchor[first] - begin).astype(np.uint64)))
        return {"text": self.text[first], "begin": begin, "end": end, "hash": self.hash[first],
                "content": content, "inner": inner}


#: Letters that are sorted as one number, at 9 bits each, and the code of an end mark.
PACKED = 7
_END = 257


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffixes of a sequence of non-negative values in order, by doubling prefixes.

    Values of 0 to 255 are letters; larger ones end a text and must grow along the sequence.
    """
    n = len(data)
    code = np.zeros(n + PACKED, np.int64)
    code[:n] = np.minimum(data, _END - 1) + 1
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(PACKED - 1, -1, -1):  # what follows an end mark does not count
        letter = code[k : k + n]
        end = letter == _END
        key = (letter << (9 * (PACKED - 1 - k))) | np.where(end, 0, key)
        ended |= end
    order = np.argsort(key)
    # Equal up to an end mark: these are told apart by the mark, which grows with the place.
    held = np.flatnonzero(ended[order])
    marked = order[held]
    order[held] = marked[np.lexsort((marked, key[marked]))]
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | ended[order[1:]]
    # Ranks are places of the first member, so they stay comparable.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step, place = PACKED, _tied(new, np.arange(n))
    while len(place):  # only suffixes that still tie are sorted again
        suffixes = order[place]
        ahead = suffixes + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[suffixes] * (n + 1) + follow
        by_key = np.argsort(key)
        suffixes, key = suffixes[by_key], key[by_key]
        order[place] = suffixes
        new = np.ones(len(place), bool)
        new[1:] = key[1:] != key[:-1]
        rank[suffixes] = np.maximum.accumulate(np.where(new, place, 0))
        place = _tied(new, place)
        step *= 2
    return order


def _tied(new: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The places of groups of more than one; `new` marks the first of each group."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return place[~alone]


def shared_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each rank, whether its suffix shares `length` letters with the one before it."""
    n = len(order)
    transform = data[order - 1]  # the letter before each suffix; the first one's is an end mark
    # Stable order by letter: rank i of letter c stands for the suffix of rank back[i] with c before it.
    back = np.argsort(transform.astype(np.uint16) if transform.max() < 1 << 16 else transform, kind="stable")
    first = transform[back]
    forward = np.empty(n, np.int64)
    forward[back] = np.arange(n)
    open_ = np.zeros(n, bool)
    open_[1:] = (first[1:] == first[:-1]) & (first[1:] < 256)
    frontier = np.flatnonzero(~open_)
    wide = np.flatnonzero(open_)
    wide = wide[back[wide] - back[wide - 1] > 1]
    for _ in range(1, length):
        if not len(frontier) or not len(wide) and not open_.any():
            break
        # Neighbours in the transform with the same letter stay neighbours when extended.
        narrow = frontier[frontier > 0]
        narrow = forward[narrow[transform[narrow] == transform[narrow - 1]]]
        narrow = narrow[open_[narrow]]
        # Others reach over the suffixes in between.
        wide = wide[open_[wide]]
        low = np.searchsorted(frontier, back[wide - 1], "right")
        high = np.searchsorted(frontier, back[wide], "right")
        reached = np.concatenate((narrow, wide[low < high]))
        open_[reached] = False
        frontier = np.unique(reached)
    return open_


def repeated_strings(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its strings of `length` bytes occur twice in all texts."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    data = np.empty(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(data), bool)
    inside[ends] = False
    data[inside] = np.frombuffer(b"".join(texts), np.uint8)
    data[ends] = 256 + np.arange(len(texts))
    order = suffix_order(data)
    same = shared_prefixes(data, order, length)
    twice = same.copy()
    twice[:-1] |= same[1:]
    found = np.zeros(len(data), bool)
    found[order[twice]] = True
    begin = ends - sizes
    return [found[a : a + max(s - length + 1, 0)] for a, s in zip(begin, sizes)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """Rows of (first, last) of the runs of True."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1), axis=1)


_FOUND = "hash long, content long, first int, last int"


def _in_blocks(contexts: DataFrame, length: int, blocks: int) -> DataFrame:
    """Repeated strings of contexts that are dealt over blocks by their anchor.

    Contexts that are known to have copies are in the blocks for the others' sake only.
    """

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        flags = repeated_strings(rows["bytes"].tolist(), length)
        out = [
            (h, c, a, b)
            for h, c, n, f in zip(rows["hash"], rows["content"], rows["copies"], flags)
            if n == 1
            for a, b in _runs(f).tolist()
        ]
        return pd.DataFrame(out, columns=["hash", "content", "first", "last"])

    block = F.pmod(F.xxhash64("hash"), F.lit(blocks)).alias("block")
    return contexts.groupBy(block).applyInPandas(search, _FOUND)


def _by_counting(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated strings of contexts whose anchor has very many: each string is counted."""

    def strings(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(_as_text(batch.column("bytes"))):
            sizes = np.diff(block.offsets) - length + 1
            number = np.repeat(np.arange(block.rows), sizes)
            place = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            sums, scale = prefix_sums(_BYTE_VALUES[block.data])
            at = block.offsets[number] + place
            columns = {
                n: np.asarray(batch.column(n).slice(block.row, block.rows))[number]
                for n in ("hash", "content", "copies")
            }
            yield columns | {"place": place, "string": mix((sums[at + length] - sums[at]) * scale[at])}

    every = arrow_map(
        contexts.select("hash", "content", "copies", "bytes"), strings,
        "hash long, content long, copies long, place int, string long",
    )
    twice = every.groupBy("hash", "string").agg(F.sum("copies").alias("n")).filter("n > 1")
    return every.filter("copies = 1").join(twice, ["hash", "string"], "left_semi").select(
        "hash", "content", F.col("place").alias("first"), F.col("place").alias("last")
    )


def _as_text(column: pa.Array) -> pa.Array:
    """Bytes seen as a string column, without a check of the encoding."""
    column = column.cast(pa.large_binary())
    return pa.LargeStringArray.from_buffers(
        len(column), *column.buffers()[1:], column.buffers()[0], column.null_count, column.offset
    )


def remove_repeats(documents: DataFrame, length: int = MIN_BYTES, seed: int = SEED_BYTES,
                   text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The documents with `n_bytes`, `n_removed`, `n_spans` and `kept_bytes`."""
    spark = documents.sparkSession
    doc_name, row_name, d_name, r_name, ranges_name = unused(documents, "__doc", "__row", "__d", "__r", "__ranges")
    keyed = documents.withColumns({
        doc_name: F.col(row_id).cast("long"), row_name: F.xxhash64(F.col(text)),
    })
    long_texts = keyed.filter(F.octet_length(text) >= length)
    texts = long_texts.select(
        F.col(doc_name).alias("doc"), F.col(row_name).alias("row"), F.col(text).alias("text")
    )

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, np.ndarray]]:
        """Blocks of the different texts of a batch, and the batch row of each text."""
        _, first = np.unique(np.asarray(batch.column("row")), return_index=True)
        first.sort()
        for block in text_blocks(batch.column("text").take(pa.array(first))):
            yield block, first[block.row : block.row + block.rows]

    def anchors(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [np.empty(0, np.uint64)]
        for block, _ in blocks(batch):
            strings = _Strings(block, length, seed)
            found.append(strings.key[strings.new])
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        yield {"hash": hashes, "n": counts}

    counted = arrow_map(texts, anchors, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    live = BitFilter(spark, counted.filter("n > 1").select("hash"), "hash")

    def occurrences(batch: pa.RecordBatch) -> Iterator[dict]:
        doc, row = batch.column("doc"), np.asarray(batch.column("row"))
        for block, rows in blocks(batch):
            strings = _Strings(block, length, seed)
            found = strings.contexts(live.contains(strings.key))
            at = rows[found["text"]]
            yield {"doc": doc.take(pa.array(at)), "row": row[at], "hash": found["hash"],
                   "content": found["content"], "size": found["end"] - found["begin"], "inner": found["inner"],
                   "begin": found["begin"] - block.offsets[found["text"]]}

    places = stored(arrow_map(
        texts, occurrences, "doc long, row long, hash long, content long, begin long, size int, inner boolean"
    ))
    kinds = places.groupBy("hash", "content").agg(
        F.count("*").alias("copies"), F.first("size").alias("size"), F.bool_or("inner").alias("inner")
    )
    per_anchor = stored(kinds.groupBy("hash").agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.bool_or("inner").alias("inner")
    ).filter("n > 1 OR inner"))
    several = BitFilter(spark, per_anchor.select("hash"), "hash")
    many = (F.col("n") > BLOCK_CONTEXTS) | (F.col("bytes") > BLOCK_BYTES)
    crowded = per_anchor.filter(many).select("hash")
    crowds = BitFilter(spark, crowded, "hash", 1 << 20)
    total = per_anchor.filter(~many).agg(F.sum("bytes")).first()[0] or 0

    def contexts(batch: pa.RecordBatch) -> Iterator[dict]:
        """Different contexts, with their bytes, of anchors that have several."""
        for block, _ in blocks(batch):
            strings = _Strings(block, length, seed)
            found = strings.contexts(live.contains(strings.key) & several.contains(strings.hash))
            _, first, counts = np.unique(found["content"], return_index=True, return_counts=True)
            data = block.data.tobytes()
            bounds = zip(found["begin"][first].tolist(), found["end"][first].tolist())
            yield {"hash": found["hash"][first], "content": found["content"][first], "copies": counts,
                   "crowd": crowds.contains(found["hash"][first]), "bytes": [data[a:b] for a, b in bounds]}

    mapped = arrow_map(texts, contexts, "hash long, content long, copies long, crowd boolean, bytes binary")
    different = stored(mapped.groupBy("hash", "content", "crowd").agg(
        F.sum("copies").alias("copies"), F.first("bytes").alias("bytes")
    ))
    found = _in_blocks(different.filter("NOT crowd"), length, int(total // BLOCK_BYTES + 1))
    if crowded.take(1):
        found = found.unionByName(_by_counting(different.filter("crowd"), length))
    # One row a context, so that none of its copies meets more than one. A copied context is
    # repeated from its first string to its last.
    copied = kinds.filter("copies > 1").select("hash", "content", (F.col("size") - length).alias("all"))
    spans = found.withColumn("all", F.lit(None).cast("int")).unionByName(copied, allowMissingColumns=True)
    run = F.struct("first", "last")
    spans = spans.groupBy("hash", "content").agg(
        F.max("all").alias("all"), F.collect_set(F.when(F.col("all").isNull(), run)).alias("runs")
    )
    whole_run = F.array(F.struct(F.lit(0).alias("first"), F.col("all").alias("last")))
    spans = spans.select("hash", "content", F.when(F.col("all").isNull(), F.col("runs")).otherwise(whole_run).alias("runs"))
    begin = F.col("begin")
    ranges = places.join(spans, ["hash", "content"]).select(
        "doc", "row", F.transform("runs", lambda r: F.struct(
            (begin + r["first"]).alias("first"), (begin + r["last"] + length).alias("end"))).alias("ranges"),
    )
    copies = (
        long_texts.groupBy(F.sha2(F.col(text), 256).alias("digest"))
        .agg(F.count("*").alias("n"), F.min(row_name).alias("row"), F.min(F.octet_length(text)).alias("end"))
        .filter("n > 1")
        .select("row", F.lit(0).cast("long").alias("first"), F.col("end").cast("long"))
    )
    whole = (
        long_texts.select(F.col(doc_name).alias("doc"), F.col(row_name).alias("row"))
        .distinct()
        .join(copies, "row")
        .select("doc", "row", F.array(F.struct("first", "end")).alias("ranges"))
    )
    by_text = (
        ranges.unionByName(whole)
        .groupBy(F.col("doc").alias(d_name), F.col("row").alias(r_name))
        .agg(F.flatten(F.collect_set("ranges")).alias(ranges_name))  # within one text
    )
    match = keyed[doc_name].eqNullSafe(by_text[d_name]) & (keyed[row_name] == by_text[r_name])
    joined = keyed.join(by_text, match, "left").drop(doc_name, row_name, d_name, r_name)
    results = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    carried = [c for c in documents.columns if c not in results]

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column(text)):
            own = batch.column(ranges_name).slice(block.row, block.rows)
            number = np.repeat(np.arange(block.rows), np.asarray(own.value_lengths().fill_null(0)))
            flat = own.flatten()
            base = block.offsets[number]
            gone = covered_ranges(
                base + np.asarray(flat.field("first")), base + np.asarray(flat.field("end")), len(block.data)
            )
            before = np.concatenate(([False], gone[:-1]))
            inner = block.offsets[:-1]
            before[inner[inner < len(gone)]] = False
            sums = lambda flags: np.concatenate(([0], np.cumsum(flags)))[block.offsets]
            bounds = sums(~gone)
            yield {n: batch.column(n).slice(block.row, block.rows) for n in carried} | {
                "n_bytes": np.diff(block.offsets),
                "n_removed": np.diff(sums(gone)),
                "n_spans": np.diff(sums(gone & ~before)),
                "kept_bytes": pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), block.rows,
                    [None, pa.py_buffer(bounds.astype(np.int64).tobytes()),
                     pa.py_buffer(block.data[~gone].tobytes())],
                ),
            }

    kinds = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*[f"`{c}`" for c in carried]).schema
    )
    return arrow_map(
        joined, cut, f"{kinds}, n_bytes long, n_removed long, n_spans long, kept_bytes binary"
    )
