"""Benchmark decontamination: test phrases searched backwards in an FM-index per shard.

Every item of the benchmark is cut into windows of `WINDOW` consecutive words; an item of
fewer words, but not none, is one window. Training texts are read in shards of about `SHARD`
bytes of whole texts. Of a shard, the runs of words that occur in test windows at all and that
are long enough for one go into an FM-index (`fm_index`): any other word or run cannot be part
of an occurrence. All windows are searched in it backwards, through ranks in the wavelet
matrix; their occurrences are located by sampled suffix positions, and overlapping and
touching ones merge into spans to remove. Texts are not shuffled. Test windows are sent to the
tasks in parts of at most about `PART_WINDOWS`; each part is one pass over the texts, which
adds to the spans of the earlier ones, so the size of the benchmark costs passes, not memory.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased, compared by 64-bit
hashes: a false occurrence needs a collision between a text's word and a test word.

Defined results: null and empty texts have no words, no spans and no items, and nothing is
searched for in a null or empty item. An item is its id as text: rows of one id are one item,
and a row without an id marks words but is no item. Every row of the documents is judged by
itself and kept, with null or repeated ids too. Extra columns are carried along, result
columns replace input columns of the same name. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from subtally.llm.common import arrow_map, lists, stored
from subtally.llm.fm_index import FMIndex
from subtally.llm.textblocks import Block, covered_ranges, text_blocks, words_of

#: Words of a test window, of which one occurrence contaminates.
WINDOW = 10
#: Bytes of text in a shard; a longer text is a shard of its own.
SHARD = 1 << 21
#: Expected test windows in a part.
PART_WINDOWS = 1 << 17
RESULTS = (
    "n_words long, n_hit long, n_items long, contaminated boolean, "
    "items array<string>, spans array<struct<first: long, end: long>>"
)

#: Bytes of words once A-Z are lower-cased: digits, a-z and all of a letter beyond ASCII.
IS_TOKEN = np.zeros(256, bool)
IS_TOKEN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_COARSE = 20


def _windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, words) with the hashes of the words of each window."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column("text"), SHARD):
            words = words_of(block, IS_TOKEN, fold=True)
            size = np.minimum(words.counts, window)
            count = np.where(size > 0, words.counts - size + 1, 0)
            row = np.repeat(np.arange(block.rows), count)
            begin = words.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            bounds = np.concatenate([[0], np.cumsum(size[row])])
            at = np.repeat(begin, size[row]) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], size[row])
            yield {"item": batch.column("item").take(pa.array(block.row + row)),
                   "words": lists(words.hash[at], bounds)}

    return arrow_map(items, cut, "item string, words array<long>").distinct()


@dataclass
class TestWindows:
    """Windows of one part by length, their items, and the words that occur in them."""

    phrases: dict[int, np.ndarray]
    items_of: dict[int, list[np.ndarray]]
    names: list[str]
    vocabulary: np.ndarray
    coarse: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> TestWindows:
        names = sorted(set(table.column("item").drop_null().to_pylist()))
        number = {name: i for i, name in enumerate(names)}
        grouped: dict[tuple[int, ...], set[int]] = {}
        for item, words in zip(table.column("item").to_pylist(), table.column("words").to_pylist()):
            held = grouped.setdefault(tuple(words), set())
            if item is not None:
                held.add(number[item])
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for words in grouped:
            by_length.setdefault(len(words), []).append(words)
        phrases = {n: np.array(rows, np.int64).view(np.uint64) for n, rows in by_length.items()}
        items_of = {
            n: [np.array(sorted(grouped[words]), np.int64) for words in rows]
            for n, rows in by_length.items()
        }
        words = [p.ravel() for p in phrases.values()]
        vocabulary = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        coarse = np.zeros(1 << _COARSE, bool)
        coarse[vocabulary >> np.uint64(64 - _COARSE)] = True
        return TestWindows(phrases, items_of, names, vocabulary, coarse)

    def knows(self, words: np.ndarray) -> np.ndarray:
        """Which words occur in a window."""
        known = self.coarse[words >> np.uint64(64 - _COARSE)]
        some = np.flatnonzero(known)
        place = np.searchsorted(self.vocabulary, words[some])
        known[some] = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == words[some]
        return known


@dataclass
class Found:
    """What a shard holds: words of each text, hit words, spans and items by text."""

    n_words: np.ndarray
    n_hit: np.ndarray
    span_text: np.ndarray
    spans: np.ndarray
    item_text: np.ndarray
    items: np.ndarray


def _runs(known: np.ndarray, text: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of runs of known words of one text, the long enough ones."""
    begins, ends = known.copy(), known.copy()
    begins[1:] &= ~known[:-1] | (text[1:] != text[:-1])
    ends[:-1] &= ~known[1:] | (text[1:] != text[:-1])
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - first >= shortest
    return first[long], (end - first)[long]


def search_shard(block: Block, tests: TestWindows, before: list | None = None) -> Found:
    """Occurrences of the windows in a shard; `before` are spans that earlier parts found."""
    words = words_of(block, IS_TOKEN, fold=True)
    text = np.repeat(np.arange(block.rows), words.counts)
    begin, end, item_text, items = [], [], [], []
    for row, spans in enumerate(before or []):
        for span in spans:
            begin.append(np.array([words.first[row] + span["first"]]))
            end.append(np.array([words.first[row] + span["end"]]))
    first, lengths = _runs(tests.knows(words.hash), text, min(tests.phrases, default=1))
    if len(first):
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(first - bounds[:-1], lengths) + np.arange(bounds[-1])
        index = FMIndex(words.hash[at], bounds)
        for size, phrases in tests.phrases.items():
            low, high = index.search(phrases)
            phrase = np.repeat(np.arange(len(phrases)), high - low)
            rows = np.repeat(low, high - low) + np.arange(len(phrase)) - np.repeat(
                np.cumsum(high - low) - (high - low), high - low)
            run, within = index.run_of(index.locate(rows))
            word = first[run] + within
            begin.append(word)
            end.append(word + size)
            # A window stands for its items once in each text.
            pair = np.unique(text[word] * len(phrases) + phrase) if len(word) else np.empty(0, np.int64)
            for one, held in zip((pair // len(phrases)).tolist(), (pair % len(phrases)).tolist()):
                items.append(tests.items_of[size][held])
                item_text.append(np.full(len(items[-1]), one))
    hit = covered_ranges(np.concatenate([np.empty(0, np.int64), *begin]),
                         np.concatenate([np.empty(0, np.int64), *end]), len(text))
    span, span_length = _runs(hit, text, 1)
    pairs = np.unique(np.stack([np.concatenate([np.empty(0, np.int64), *item_text]),
                                np.concatenate([np.empty(0, np.int64), *items])]), axis=1)
    inside = span - words.first[text[span]]
    return Found(words.counts, np.bincount(text[hit], minlength=block.rows),
                 text[span], np.stack([inside, inside + span_length]), pairs[0], pairs[1])


def _list(row: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    """List column from values and their ascending rows."""
    bounds = np.searchsorted(row, np.arange(rows + 1))
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def _judged(batch: pa.RecordBatch, text: str, tests: TestWindows, again: bool) -> dict[str, pa.Array]:
    parts: dict[str, list[pa.Array]] = {}
    spans_before = batch.column("spans").to_pylist() if again else None
    items_before = batch.column("items").to_pylist() if again else None
    for block in text_blocks(batch.column(text), SHARD):
        rows = slice(block.row, block.row + block.rows)
        found = search_shard(block, tests, spans_before[rows] if again else None)
        names = pa.array(tests.names, pa.string()).take(pa.array(found.items))
        items = _list(found.item_text, block.rows, names)
        if again:
            both = zip(items.to_pylist(), items_before[rows])
            items = pa.array([sorted({*new, *old}) for new, old in both], pa.list_(pa.string()))
        first, end = found.spans
        spans = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"])
        columns = {
            "n_words": pa.array(found.n_words), "n_hit": pa.array(found.n_hit),
            "n_items": items.value_lengths().cast(pa.int64()),
            "contaminated": pa.array(found.n_hit > 0),
            "items": items, "spans": _list(found.span_text, block.rows, spans),
        }
        for name, values in columns.items():
            parts.setdefault(name, []).append(values)
    return {name: pa.concat_arrays(values) for name, values in parts.items()}


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """Every row of `documents` with what it shares with the benchmark.

    n_words; n_hit, its words inside an occurrence; n_items and `items`, the ids in order of
    the items that occur; `spans`, the runs [first, end) of hit words to remove;
    contaminated, whether there are any.
    """
    spark = documents.sparkSession
    windows = stored(_windows(benchmark, item_id, item_text, window))
    parts = max(1, -(-windows.count() // part_windows))
    part = F.pmod(F.xxhash64("words", "item"), F.lit(parts))
    results = StructType.fromDDL(RESULTS)
    # A text column of a result's name is read under another one.
    read_as = text if text not in results.names else f"{text}_of_row"
    judged = documents if read_as == text else documents.withColumnRenamed(text, read_as)
    for number in range(parts):
        table = windows.filter(part == number).toArrow()  # about PART_WINDOWS rows
        tests = spark.sparkContext.broadcast(TestWindows.of(table))
        judged = _pass(judged, read_as, tests, results, again=number > 0)
        if number + 1 < parts:
            judged = stored(judged)
    return judged


def _pass(frame: DataFrame, text: str, tests, results: StructType, again: bool) -> DataFrame:
    names = frame.columns
    kept = [field for field in frame.schema.fields if field.name not in results.names]
    schema = StructType([*kept, *results.fields])
    target = to_arrow_schema(schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch = batch.rename_columns(names)
                found = _judged(batch, text, tests.value, again)
                arrays = [found[f.name] if f.name in found else batch.column(f.name) for f in target]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, target)], schema=target)

    # By place, because names may hold dots.
    return frame.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(judge, schema)
