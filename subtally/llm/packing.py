"""Best-fit packing into sequences of several permitted lengths.

A text is a number of words. Whole stretches of the largest permitted length become full
sequences; what is left over is dealt by hash into groups of bounded expected size and
packed there, longest first. A piece goes to the open bin it fills best; if none has room,
a bin is opened. The permitted sizes are planned jointly: every opening size is tried (a
piece that needs more opens the next size that holds it), each bin is cut down to the
least size that holds its contents, and the plan of least cost is taken. A sequence costs
its length plus a fixed amount.

Nothing is lost or cut short: the pieces of a text lie one after another and cover it.
Defined results: a text without words (null, empty) gives one row of length 0 without a
sequence. Repeated rows are numbered by `copy` and packed one by one. Null ids are kept.
Only the id and the text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import arrow_map
from subtally.llm.textblocks import text_blocks, words_of

CAPACITIES = (256, 512, 1024, 2048)
#: Cost of a sequence besides its length.
SEQUENCE_COST = 32
#: Expected number of pieces packed in one task at a time.
GROUP_PIECES = 20_000


def best_fit(lengths: np.ndarray, opening: int, capacities: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each length (given longest first) and room used in each bin."""
    free: list[tuple[int, int]] = []  # (room, bin), in order
    used: list[int] = []
    bins = np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        at = bisect_left(free, (n, -1))
        if at < len(free):
            room, chosen = free.pop(at)
        else:
            room = max(opening, next(c for c in capacities if c >= n))
            chosen = len(used)
            used.append(0)
        bins[i] = chosen
        used[chosen] += n
        if room > n:
            insort(free, (room - n, chosen))
    return bins, np.array(used, np.int64)


def plan(lengths: np.ndarray, capacities: tuple[int, ...], cost: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and their final sizes of the cheapest opening size."""
    sizes = np.array(capacities)
    best = None
    for opening in capacities:
        bins, used = best_fit(lengths, opening, capacities)
        final = sizes[np.searchsorted(sizes, used)]
        price = int(final.sum()) + cost * len(final)
        if best is None or price < best[0]:
            best = price, bins, final
    return best[1], best[2]


def word_counts(documents: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """doc_id, text_hash and n_words of every row."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column("text")):
            yield {n: batch.column(n).slice(block.row, block.rows) for n in ("doc_id", "text_hash")} | {
                "n_words": words_of(block).counts
            }

    keyed = documents.select(
        F.col(row_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return arrow_map(keyed, rows, "doc_id long, text_hash long, n_words long")


def pack(documents: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost: int = SEQUENCE_COST,
         group_pieces: int = GROUP_PIECES, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, copy, first_word, length, sequence, capacity, offset."""
    capacities = tuple(sorted(capacities))
    largest = capacities[-1]
    rows = (
        word_counts(documents, text, row_id)
        .groupBy("doc_id", "text_hash", "n_words").count()
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count"))))
        .drop("count")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.col("n_words") - 1, F.lit(0)), F.lit(largest))
    pieces = rows.withColumn("first_word", F.explode(starts)).withColumn(
        "length", F.least(F.lit(largest), F.col("n_words") - F.col("first_word"))
    )
    key = F.xxhash64("doc_id", "text_hash", "copy", "first_word")
    names = ["doc_id", "copy", "first_word", "length"]
    full = pieces.filter(F.col("length") == largest).select(
        *names, F.concat(F.lit("f"), F.hex(key), F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        .alias("sequence"),
        F.lit(largest).alias("capacity"), F.lit(0).cast("long").alias("offset"),
    )
    empty = pieces.filter("length = 0").select(
        *names, F.lit(None).cast("string").alias("sequence"), F.lit(None).cast("int").alias("capacity"),
        F.lit(None).cast("long").alias("offset"),
    )
    partial = pieces.filter((F.col("length") > 0) & (F.col("length") < largest))
    groups = partial.count() // group_pieces + 1

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        bins, final = plan(group["length"].to_numpy(), capacities, cost)
        out = group[names].copy()
        number = group["group"].iloc[0]
        out["sequence"] = [f"g{number}-{b}" for b in bins]
        out["capacity"] = final[bins]
        out["offset"] = out.groupby("sequence")["length"].cumsum() - out["length"]
        return out

    kinds = "doc_id long, copy long, first_word long, length long, sequence string, capacity int, offset long"
    dealt = partial.select(*names, key.alias("key"), F.pmod(key, F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(packed, kinds).unionByName(full).unionByName(empty)
