"""Quality rules: surface counts and a hashed n-gram likelihood ratio for every document.

Two multinomials over hashed word uni- and bigrams are counted: one over all documents
(raw corpus), one over all trusted documents. A document's score is its mean log ratio of
the two, so length does not matter; one threshold, derived from trusted documents that are
scored without their own counts, gives the verdict.

Defined results: a null or empty text has no words, all counts 0, base_failed true and
score null. Repeated rows get equal results, row by row. A null doc_id is passed through
and is never trusted. Extra columns are ignored. An empty table gives an empty result;
without trusted documents the score is 0 for all texts with words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import arrow_map
from subtally.llm.textblocks import (
    IS_WORD, Block, Words, covered, mix, prefix_sums, text_blocks, window_hashes, words_of,
    _BYTE_VALUES,
)

#: Buckets of the hashed n-grams: the model is two arrays of this length.
BUCKETS = 1 << 16
#: Up to so many trusted ids (of 8 bytes) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20
#: The threshold is this quantile of the trusted texts' held-out scores, less the margin.
LOW_QUANTILE = 0.005
MARGIN = 0.05
SMOOTHING = 1.0
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE_END = 0x0A

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(flags: np.ndarray, block: Block) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return np.diff(sums[block.offsets])


def _own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that only meet within one text of a block."""
    return mix(hashes ^ mix((text + 1).astype(np.uint64)))


def _dup_lines(block: Block) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(block.data)
    ends = np.flatnonzero(block.data == _LINE_END)
    cuts = block.offsets[1:]
    edges = np.union1d(ends, cuts)
    is_break = np.zeros(n + 1, bool)
    is_break[ends] = True
    starts = np.concatenate(([0], np.where(is_break[edges[:-1]], edges[:-1] + 1, edges[:-1])))
    starts = np.minimum(starts, edges)
    words = np.concatenate(([0], np.cumsum(IS_WORD[block.data])))
    full = words[edges] > words[starts]
    starts, edges = starts[full], edges[full]
    sums, scale = prefix_sums(_BYTE_VALUES[block.data])
    text = np.searchsorted(block.offsets, starts, "right") - 1
    own = _own((sums[edges] - sums[starts]) * scale[starts], text)
    _, first = np.unique(own, return_index=True)
    lines = np.bincount(text, minlength=block.rows)
    return lines - np.bincount(text[first], minlength=block.rows)


def _repeat_words(words: Words, rows: int) -> np.ndarray:
    at, hashes = window_hashes(words, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(rows, np.int64)
    own = _own(hashes, np.searchsorted(words.first, at, "right") - 1)
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    marked = covered(at[twice], REPEAT_WINDOW, len(words.start))
    return np.diff(np.concatenate(([0], np.cumsum(marked)))[words.first])


def base_counts(block: Block) -> dict[str, np.ndarray]:
    words = words_of(block)
    inside = IS_WORD[block.data] & ((block.data & 0xC0) != 0x80)
    return {
        "n_words": words.counts,
        "word_chars": _per_text(inside, block),
        "n_symbols": _per_text(_SYMBOL[block.data], block),
        "n_dup_lines": _dup_lines(block),
        "n_repeat_words": _repeat_words(words, block.rows),
    }


def gram_buckets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every word and every pair of neighbouring words."""
    words = words_of(block, fold=True)
    at, pairs = window_hashes(words, 2)
    hashes = np.concatenate((words.hash, pairs))
    start = np.concatenate((np.arange(len(words.start)), at))
    text = np.searchsorted(words.first, start, "right") - 1
    return text, (hashes >> np.uint64(48)).astype(np.int64)


def _counted(batch: pa.RecordBatch) -> Iterator[dict]:
    """Bucket counts of a batch: over all texts, and over trusted ones."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    trusted = np.asarray(batch.column("trusted").fill_null(False))
    for block in text_blocks(batch.column("text")):
        text, bucket = gram_buckets(block)
        raw += np.bincount(bucket, minlength=BUCKETS)
        target += np.bincount(bucket[trusted[block.row + text]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield {"bucket": used, "raw": raw[used], "target": target[used]}


class Ratio:
    """Bucket counts of the raw corpus and of trusted texts, and their log ratio."""

    def __init__(self, raw: np.ndarray, target: np.ndarray):
        self.raw, self.target = raw, target

    def _smooth(self, counts: np.ndarray, total: float) -> np.ndarray:
        return np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS))

    def table(self) -> np.ndarray:
        if not self.target.sum():
            return np.zeros(BUCKETS)
        return self._smooth(self.target, self.target.sum()) - self._smooth(self.raw, self.raw.sum())

    def without(self, bucket: np.ndarray) -> float:
        """Score of a trusted text by the counts of all other trusted texts."""
        used, own = np.unique(bucket, return_counts=True)
        target = self._smooth(self.target[used] - own, self.target.sum() - len(bucket))
        raw = self._smooth(self.raw[used], self.raw.sum())
        return float((own * (target - raw)).sum() / len(bucket))


def _marked(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """text and whether it belongs to a trusted id."""
    ids = trusted.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    few = ids.count() <= BROADCAST_IDS
    ids = ids.withColumn("trusted", F.lit(True))
    texts = documents.select("doc_id", "text")
    return texts.join(F.broadcast(ids) if few else ids, "doc_id", "left").drop("doc_id")


def fit(documents: DataFrame, trusted: DataFrame) -> tuple[Ratio, float]:
    """The two multinomials, and the least score that still passes.

    The threshold follows from the trusted texts: each is scored without its own counts,
    as a text outside the sample would be, and `MARGIN` is taken off a low quantile.
    """
    marked = _marked(documents, trusted)
    counts = arrow_map(marked, _counted, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, m in counts.collect():  # at most BUCKETS rows
        raw[bucket], target[bucket] = n, m
    ratio = Ratio(raw, target)
    shared = documents.sparkSession.sparkContext.broadcast(ratio)

    def held_out(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column("text")):
            base = base_counts(block)
            text, bucket = gram_buckets(block)
            order = np.argsort(text, kind="stable")
            parts = np.split(bucket[order], np.searchsorted(text[order], np.arange(1, block.rows)))
            passed = ~fails(base["n_words"], base["n_repeat_words"])
            yield {"score": [shared.value.without(x) for x, ok in zip(parts, passed) if ok]}

    scores = arrow_map(marked.filter("trusted"), held_out, "score double")
    low, n = scores.agg(F.percentile("score", F.lit(LOW_QUANTILE)), F.count("score")).first()
    return ratio, low - MARGIN if n else -np.inf


def fails(n_words, n_repeat_words):
    """Whether the base counts alone reject a text; works on arrays and on columns."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def score_quality(
    documents: DataFrame, trusted: DataFrame, threshold: float | None = None
) -> DataFrame:
    """The documents with their counts, `base_failed`, `score` and `kept`.

    All input columns are returned; result columns replace input columns of the same name.
    Without a `threshold` the one that `fit` derives is used.
    """
    ratio, derived = fit(documents, trusted)
    threshold = derived if threshold is None else threshold
    model = documents.sparkSession.sparkContext.broadcast(ratio.table())

    def scored(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column("text")):
            columns = base_counts(block)
            text, bucket = gram_buckets(block)
            total = np.bincount(text, weights=model.value[bucket], minlength=block.rows)
            grams = np.bincount(text, minlength=block.rows)
            columns["score"] = pa.array(total / np.maximum(grams, 1), mask=grams == 0)
            passed = {n: batch.column(n).slice(block.row, block.rows) for n in names}
            yield passed | columns

    results = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score",
               "base_failed", "kept"}
    carried = documents.select(*[f"`{c}`" for c in documents.columns if c not in results])
    names = carried.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)
    failed = fails(F.col("n_words"), F.col("n_repeat_words"))
    return (
        arrow_map(carried, scored, f"{kinds}, {COUNTS}, score double")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold))
    )
