"""Substring dedup by words: passages that a document with a smaller id also holds go.

Anchors are runs of `anchor_words` words that begin at the positions of a difference cover
modulo a period. For any two positions some shift below the period brings both onto the
cover, and period + anchor - 1 is the passage length, so any two equal passages hold an
equal anchor at the same place inside them. Anchors that only one document has are
dropped; each remaining one is extended to all windows of full length around it, and of
each window the smallest document that has it is found. Removing is then exact: a word
goes if a window over it also begins in a document with a smaller id.

Neighbouring windows with the same minimal anchor travel together, as one context. Equal
contexts are combined before the shuffle, whatever the number of their documents; the
different contexts of one anchor meet in a block of bounded size, and where an anchor has
more than `BLOCK_CONTEXTS` of them its windows are aggregated one by one instead. Texts
that are equal as a whole need windows only once: later copies lose all words of a text
that has windows. The live anchors travel to the tasks as a bit filter of fixed size, which
only saves work (see `BitFilter`). Windows are compared by 64-bit hashes.

Defined results: null and empty texts have no words. Null ids count as larger than all
others, and rows of equal id never remove each other's words, so of repeated rows all stay.
Extra columns are carried along, result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import BitFilter, arrow_map, lists, stored, unused
from subtally.llm.suffix_dedup import leftmost_minima
from subtally.llm.textblocks import (
    Block, Words, covered, covered_ranges, mix, prefix_sums, text_blocks, window_hashes, words_of,
)

MIN_WORDS = 50
ANCHOR_WORDS = 20
#: Different contexts of one key that may share a block, and windows that a block aims at.
BLOCK_CONTEXTS = 2048
BLOCK_WINDOWS = 1 << 18
_LAST_ID = (1 << 63) - 1
_U = np.uint64
#: A perfect difference set, each difference modulo 31 occurs exactly once.
_PERFECT_31 = [1, 5, 11, 24, 25, 27]


def difference_cover(period: int) -> np.ndarray:
    """Residues whose pairwise differences give every residue."""
    if period == 31:
        return np.array(_PERFECT_31)
    step = isqrt(period - 1) + 1
    return np.unique(np.concatenate((np.arange(step), np.arange(0, period + step, step)) ) % period)


def _cover_positions(words: Words, period: int) -> np.ndarray:
    """Which words of a block stand at a cover position of their text."""
    on_cover = np.zeros(period, bool)
    on_cover[difference_cover(period)] = True
    place = np.arange(len(words.start)) - np.repeat(words.first[:-1], words.counts)
    return on_cover[place % period]


def _anchors(words: Words, size: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    at, hashes = window_hashes(words, size)
    chosen = _cover_positions(words, period)[at]
    return at[chosen], hashes[chosen]


def _first_of_each_text(batch: pa.RecordBatch) -> np.ndarray:
    """For equal texts of a batch only the row of smallest id is True."""
    doc, text = np.asarray(batch.column("doc")), np.asarray(batch.column("text_hash"))
    order = np.lexsort((doc, text))
    first = np.ones(len(order), bool)
    first[1:] = text[order][1:] != text[order][:-1]
    out = np.zeros(len(order), bool)
    out[order] = first
    return out


def _extremes(hashes: list[np.ndarray], docs: list[np.ndarray]) -> dict:
    """Smallest and largest document of each hash of a batch."""
    if not hashes:
        return {"hash": [], "low": [], "high": []}
    every, doc = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(every, kind="stable")
    every, doc = every[order], doc[order]
    begin = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else []
    if not len(every):
        return {"hash": every, "low": doc, "high": doc}
    return {
        "hash": every[begin],
        "low": np.minimum.reduceat(doc, begin),
        "high": np.maximum.reduceat(doc, begin),
    }


def _text_number(words: Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, at, "right") - 1


def _keep_words(block: Block, words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each text, joined by one space."""
    text = np.repeat(np.arange(block.rows), words.counts)
    kept = np.flatnonzero(keep)
    data = np.append(block.data, np.uint8(0x20))
    mask = np.zeros(len(data) + 1, np.int8)
    np.add.at(mask, words.start[kept], 1)
    np.add.at(mask, words.end[kept], -1)
    mask = np.cumsum(mask[:-1]).astype(bool)
    more = np.flatnonzero(text[kept][:-1] == text[kept][1:])
    gaps = words.end[kept[more]]
    data[gaps] = 0x20
    mask[gaps] = True
    bounds = np.concatenate(([0], np.cumsum(mask)))[block.offsets]
    return pa.LargeStringArray.from_buffers(
        block.rows, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data[mask].tobytes())
    ).cast(pa.string())


class _Windows:
    """Windows around live anchors of a block, in contexts that share a minimal anchor."""

    def __init__(self, block: Block, live: BitFilter, wanted: np.ndarray, size: int, anchor: int):
        period = size - anchor + 1
        self.words, self.size = words_of(block), size
        words = self.words
        at, found = window_hashes(words, anchor)
        on_cover = _cover_positions(words, period)[at]
        alive = at[on_cover][live.contains(found[on_cover])]
        near = covered(np.maximum(alive - period + 1, 0), period, len(words.start))
        start, hashes = window_hashes(words, size)
        chosen = near[start] & wanted[_text_number(words, start)]
        self.start, self.hashes = start[chosen], hashes[chosen]
        least = leftmost_minima(found, period)
        self.least = least[np.searchsorted(at, self.start)] if len(self.start) else self.start
        new = np.ones(len(self.start), bool)
        new[1:] = (np.diff(self.start) != 1) | (np.diff(self.least) != 0)
        self.first = np.flatnonzero(new)
        self.bounds = np.append(self.first, len(self.start))
        self.key = found[self.least[self.first]]
        begin, count = self.start[self.first], np.diff(self.bounds)
        sums, scale = prefix_sums(words.hash)
        shape = (count.astype(np.uint64) << _U(32)) + (at[self.least[self.first]] - begin).astype(np.uint64)
        self.run = mix(mix((sums[begin + count - 1 + size] - sums[begin]) * scale[begin]) ^ mix(shape + _U(1)))
        self.text = _text_number(words, begin)
        self.place = begin - words.first[self.text]


def _owned(rows: pd.DataFrame) -> pd.DataFrame:
    """Smallest document of each window of the contexts of a block, where others have it too."""
    sizes = np.array([len(h) for h in rows["hashes"]])
    run = np.repeat(np.arange(len(rows)), sizes)
    _, window = np.unique(np.concatenate(rows["hashes"].to_list()), return_inverse=True)
    low = np.full(window.max() + 1, _LAST_ID)
    high = np.full(window.max() + 1, -(1 << 63))
    np.minimum.at(low, window, rows["low"].to_numpy()[run])
    np.maximum.at(high, window, rows["high"].to_numpy()[run])
    place = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    use = np.flatnonzero((low < high)[window])
    run, place, least = run[use], place[use], low[window[use]]
    new = np.ones(len(use), bool)
    new[1:] = (np.diff(run) != 0) | (np.diff(place) != 1) | (np.diff(least) != 0)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(use)) - 1
    picked = rows.iloc[run[begin]]
    return pd.DataFrame({
        "key": picked["key"].to_numpy(), "run": picked["run"].to_numpy(),
        "first": place[begin], "last": place[end] if len(use) else place, "low": least[begin],
    })


_OWNED = "key long, run long, first int, last int, low long"


def _in_blocks(contexts: DataFrame, blocks: int) -> DataFrame:
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")
    return contexts.groupBy(block).applyInPandas(_owned, _OWNED)


def _one_by_one(contexts: DataFrame) -> DataFrame:
    """The same for the contexts of crowded keys, window by window."""
    every = contexts.select("key", "run", "low", "high", F.posexplode("hashes").alias("first", "window"))
    least = every.groupBy("window").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return every.select("key", "run", "first", "window").join(least.filter("low < high"), "window").select(
        "key", "run", "first", F.col("first").alias("last"), "low"
    )


def remove_passages(documents: DataFrame, min_words: int = MIN_WORDS,
                    anchor_words: int = ANCHOR_WORDS, text: str = "text",
                    row_id: str = "doc_id") -> DataFrame:
    """The documents with `n_words`, `n_removed`, `removed` runs of words and `kept_text`."""
    spark = documents.sparkSession
    period = min_words - anchor_words + 1
    doc_name, row_name, ranges_name, whole_name = unused(documents, "__doc", "__row", "__ranges", "__whole")
    keyed = documents.withColumns({
        doc_name: F.coalesce(F.col(row_id).cast("long"), F.lit(_LAST_ID)),
        row_name: F.xxhash64(F.col(text)),
    })
    texts = keyed.select(
        F.col(doc_name).alias("doc"), F.col(row_name).alias("text_hash"), F.col(text).alias("text")
    )

    def anchors(batch: pa.RecordBatch) -> Iterator[dict]:
        wanted, doc = _first_of_each_text(batch), np.asarray(batch.column("doc"))
        whole = _copies(batch, doc)
        hashes, docs = [], []
        for block in text_blocks(batch.column("text")):
            words = words_of(block)
            at, found = _anchors(words, anchor_words, period)
            row = block.row + _text_number(words, at)
            hashes += [found[wanted[row]]] * 2
            docs += [doc[row[wanted[row]]], whole[row[wanted[row]]]]
        # Equal anchors of a batch are one row here, so nothing is left to combine before the shuffle.
        yield _extremes(hashes, docs)

    found = arrow_map(texts, anchors, "hash long, low long, high long")
    live = found.groupBy("hash").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    filtered = BitFilter(spark, live.filter("low < high").select("hash"), "hash")

    def windows(batch: pa.RecordBatch) -> Iterator[tuple[Block, _Windows]]:
        wanted = _first_of_each_text(batch)
        for block in text_blocks(batch.column("text")):
            own = wanted[block.row : block.row + block.rows]
            yield block, _Windows(block, filtered, own, min_words, anchor_words)

    def places(batch: pa.RecordBatch) -> Iterator[dict]:
        doc, text_hash = np.asarray(batch.column("doc")), np.asarray(batch.column("text_hash"))
        whole = _copies(batch, doc)
        for block, w in windows(batch):
            row = block.row + w.text
            yield {"key": w.key, "run": w.run, "doc": doc[row], "text_hash": text_hash[row],
                   "high": whole[row], "place": w.place, "size": np.diff(w.bounds)}

    placed = stored(arrow_map(
        texts, places, "key long, run long, doc long, text_hash long, high long, place int, size int"
    ))
    runs = placed.groupBy("key", "run").agg(
        F.min("doc").alias("low"), F.max("high").alias("high"), F.first("size").alias("size")
    )
    per_key = runs.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("windows"))
    several = BitFilter(spark, per_key.filter("n > 1").select("key"), "key")
    crowded = per_key.filter(f"n > {BLOCK_CONTEXTS}").select("key")
    crowds = BitFilter(spark, crowded, "key", 1 << 20)
    total = per_key.filter(f"n BETWEEN 2 AND {BLOCK_CONTEXTS}").agg(F.sum("windows")).first()[0] or 0

    def contexts(crowd: bool) -> DataFrame:
        """Different contexts, with their windows, of keys that have several."""

        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            doc = np.asarray(batch.column("doc"))
            whole = _copies(batch, doc)
            for block, w in windows(batch):
                use = np.flatnonzero(several.contains(w.key) & (crowds.contains(w.key) == crowd))
                low, high = doc[block.row + w.text[use]], whole[block.row + w.text[use]]
                _, one, same = np.unique(w.run[use], return_index=True, return_inverse=True)
                least, most, at = low[one], high[one], use[one]
                np.minimum.at(least, same, low)
                np.maximum.at(most, same, high)
                sizes = np.diff(w.bounds)[at]
                ends = np.cumsum(sizes)
                flat = np.repeat(w.first[at] - (ends - sizes), sizes) + np.arange(sizes.sum())
                yield {"key": w.key[at], "run": w.run[at], "low": least, "high": most,
                       "hashes": lists(w.hashes[flat], np.concatenate(([0], ends)))}

        kinds = "key long, run long, low long, high long, hashes array<long>"
        return arrow_map(texts, rows, kinds).groupBy("key", "run").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.first("hashes").alias("hashes")
        )

    # A context that several documents share is owned by the smallest of them ...
    owned = runs.filter("low < high").select(
        "key", "run", F.lit(0).alias("first"), (F.col("size") - 1).alias("last"), "low"
    )
    # ... and single windows of it perhaps by one that shares only these.
    owned = owned.unionByName(_in_blocks(contexts(False), int(total // BLOCK_WINDOWS + 1)))
    if crowded.take(1):
        owned = owned.unionByName(_one_by_one(contexts(True)))
    marks = (
        placed.join(owned, ["key", "run"])
        .filter("low < doc")
        .select(
            "doc", "text_hash",
            F.struct(
                (F.col("place") + F.col("first")).alias("first"),
                (F.col("place") + F.col("last") + min_words).alias("end"),
            ).alias("range"),
            F.lit(False).alias("whole"),
        )
    )
    small = keyed.select(
        F.col(doc_name).alias("doc"), F.col(row_name).alias("text_hash"),
        F.sha2(F.col(text), 256).alias("digest"),
    )
    first = small.groupBy("digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    copies = (
        small.join(first.filter("least < most"), "digest")
        .filter("doc > least")
        .select("doc", "text_hash", F.lit(None).cast("struct<first:int,end:int>").alias("range"),
                F.lit(True).alias("whole"))
        .distinct()
    )
    by_text = (
        marks.unionByName(copies)
        .groupBy(F.col("doc").alias(doc_name), F.col("text_hash").alias(row_name))
        # Ranges of one text, at most one for each of its words.
        .agg(F.collect_set("range").alias(ranges_name), F.bool_or("whole").alias(whole_name))
    )
    joined = keyed.join(by_text, [doc_name, row_name], "left").drop(doc_name, row_name)
    results = ("n_words", "n_removed", "removed", "kept_text")
    carried = [c for c in documents.columns if c not in results]

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        whole = np.asarray(batch.column(whole_name).fill_null(False))
        for block in text_blocks(batch.column(text)):
            words = words_of(block)
            own = batch.column(ranges_name).slice(block.row, block.rows)
            number = np.repeat(np.arange(block.rows), np.asarray(own.value_lengths().fill_null(0)))
            flat, base = own.flatten(), words.first[number]
            everything = whole[block.row : block.row + block.rows] & (words.counts >= min_words)
            first = np.concatenate((base + np.asarray(flat.field("first")), words.first[:-1][everything]))
            end = np.concatenate((base + np.asarray(flat.field("end")), words.first[1:][everything]))
            gone = covered_ranges(first.astype(np.int64), end.astype(np.int64), len(words.start))
            sums = np.concatenate(([0], np.cumsum(gone)))[words.first]
            yield {n: batch.column(n).slice(block.row, block.rows) for n in carried} | {
                "n_words": words.counts,
                "n_removed": np.diff(sums),
                "removed": _runs(words, gone, block.rows),
                "kept_text": _keep_words(block, words, ~gone),
            }

    kinds = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*[f"`{c}`" for c in carried]).schema
    )
    return arrow_map(
        joined, cut,
        f"{kinds}, n_words long, n_removed long, removed array<long>, kept_text string",
    )


def _copies(batch: pa.RecordBatch, doc: np.ndarray) -> np.ndarray:
    """For each row the largest id of a row of the batch with the same text."""
    text = np.asarray(batch.column("text_hash"))
    order = np.argsort(text, kind="stable")
    if not len(order):
        return doc
    begin = np.flatnonzero(np.concatenate(([True], text[order][1:] != text[order][:-1])))
    most = np.maximum.reduceat(doc[order], begin)
    out = np.empty_like(doc)
    out[order] = np.repeat(most, np.diff(np.append(begin, len(order))))
    return out


def _runs(words: Words, gone: np.ndarray, rows: int) -> pa.Array:
    """Removed runs of each text as first word and end of run, in turn, from word 0."""
    change = np.zeros(len(gone) + 1, bool)
    change[1:-1] = gone[1:] != gone[:-1]
    inner = words.first[(words.first > 0) & (words.first < len(gone))]
    before = np.concatenate(([False], gone))
    after = np.concatenate((gone, [False]))
    begins = after & (change | ~before)
    ends = before & (change | ~after)
    begins[inner] = after[inner]
    ends[inner] = before[inner]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    number = _text_number(words, first)
    flat = np.stack((first - words.first[number], last - words.first[number]), axis=1).ravel()
    counts = np.bincount(number, minlength=rows) * 2
    return lists(flat.astype(np.int64), np.concatenate(([0], np.cumsum(counts))))
