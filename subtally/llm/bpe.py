"""BPE encoding and decoding of whole texts with a given vocabulary file.

Texts up to `LONG_CHARS` are encoded where they lie. A longer text is cut into halves, and
these again, down to leaves of at most `LEAF_CHARS`; Spark spreads the leaves over all
tasks. Neighbouring parts are then joined pairwise up the tree: a window around the cut is
encoded on its own and doubled until it shares a token run with the left part and one with
the right part; the joined sequence is left up to the first run, window, right from the
second run. A sequence of byte-pair tokens is the encoding of its text exactly if each
neighbouring pair is, and every pair of the joined sequence stands in one of the three, so
the result equals the encoding of the unsplit text. If the window reaches both ends first,
it is the encoding itself.

White space never lies inside a token, so in short texts each stretch between white space
is encoded once per task and remembered (a bounded memory of distinct stretches).

Defined results: null and empty texts have no tokens and decode to the empty text.
Repeated rows and null ids are kept row by row. Extra columns are carried along; `ids`
(or the result of decoding) replaces an input column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Sequence

from subtally.llm.common import arrow_map

LONG_CHARS = 1 << 16
LEAF_CHARS = 1 << 14
FIRST_WINDOW = 64
#: Distinct stretches remembered in one task, and the longest that is.
REMEMBERED, STRETCH_CHARS = 500_000, 64

#: Letters that are composed already and fall to lower case one by one, printable ASCII and
#: ASCII white space: here splitting at white space commutes with normalisation.
_PLAIN = re.compile("[\t-\r\x20-\x7eÀ-įı-ž]*")


class Codec:
    """The vocabulary file opened in one task."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.normalized = Tokenizer.from_file(path)
        self.normalizer = self.normalized.normalizer
        self.normalized.normalizer = Sequence([])
        self.normalized.encode_special_tokens = True
        added = self.whole.get_added_tokens_decoder()
        self.added = {token.content: i for i, token in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if added else None
        self._known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        if not _PLAIN.fullmatch(text) or (self.special and self.special.search(text)):
            return self.whole.encode(text, add_special_tokens=False).ids
        stretches = text.split()
        if len(self._known) > REMEMBERED:
            self._known.clear()
        new = {s for s in stretches if s not in self._known}
        learned = self._learn(new) if new else {}
        long = {s: learned.pop(s) for s in new if len(s) > STRETCH_CHARS}
        self._known.update(learned)
        if long:
            return list(chain.from_iterable(long[s] if s in long else self._known[s] for s in stretches))
        return list(chain.from_iterable(map(self._known.__getitem__, stretches)))

    def _learn(self, stretches: set[str]) -> dict[str, tuple[int, ...]]:
        """Encode distinct stretches in one text, split again at their first characters."""
        order = list(stretches)
        encoded = self.whole.encode(" ".join(order), add_special_tokens=False)
        ids = encoded.ids
        starts = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(ids))
        lengths = np.fromiter(map(len, order), np.int64, len(order))
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths + 1))))
        return {s: tuple(ids[a:b]) for s, a, b in zip(order, bounds.tolist(), bounds[1:].tolist())}

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """(is an added token, text): added tokens stand apart, the rest is normalised."""
        pieces = self.special.split(text) if self.special else [text]
        return [
            (at % 2 == 1, piece if at % 2 else self.normalizer.normalize_str(piece))
            for at, piece in enumerate(pieces)
            if piece
        ]

    def tokens(self, text: str, start: int = 0) -> np.ndarray:
        """Rows of (start, end, id) of normalised text that begins at `start`."""
        encoded = self.normalized.encode(text, add_special_tokens=False)
        out = np.empty((len(encoded.ids), 3), np.int64)
        if len(out):
            out[:, :2] = encoded.offsets
            out[:, :2] += start
            out[:, 2] = encoded.ids
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def leaves(length: int, leaf: int = LEAF_CHARS) -> list[tuple[int, int]]:
    """Bounds of the leaves of the halving tree over `length` characters."""
    if length <= leaf:
        return [(0, length)]
    half = length // 2
    return leaves(half, leaf) + [(a + half, b + half) for a, b in leaves(length - half, leaf)]


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[int, int] | None:
    """Places in a and b of two equal neighbouring tokens with bounds of their own."""
    if len(a) < 2 or len(b) < 2:
        return None
    places = {}
    for i in range(len(a) - 1):
        places[(*a[i], *a[i + 1])] = i
    for k in range(len(b) - 1):
        i = places.get((*b[k], *b[k + 1]))
        if i is not None and b[k, 0] < b[k + 1, 0] and b[k, 1] <= b[k + 1, 0]:
            return i, k
    return None


def join_parts(opened: Codec, text: str, left: np.ndarray, right: np.ndarray, cut: int,
               low: int, high: int) -> np.ndarray:
    """Tokens of text[low:high] from those of text[low:cut] and text[cut:high]."""
    reach = FIRST_WINDOW
    while True:
        a, b = max(low, cut - reach), min(high, cut + reach)
        window = opened.tokens(text[a:b], a)
        if a == low and b == high:
            return window
        near_left = left[np.searchsorted(left[:, 0], a) :]
        near_right = right[: np.searchsorted(right[:, 1], b, "right")]
        begin = (0, 0) if a == low else _shared(near_left, window)
        end = (0, 0) if b == high else _shared(window[::-1], near_right[::-1])
        if begin and end:
            first, last = begin[1], len(window) - end[0]
            kept_left = len(left) - len(near_left) + begin[0] if a != low else 0
            kept_right = len(near_right) - end[1] if b != high else len(right)
            if first < last - 2 or a == low or b == high:
                return np.concatenate((left[:kept_left], window[first:last], right[kept_right:]))
        reach *= 2


def join_tree(opened: Codec, text: str, coded: dict[int, np.ndarray], low: int, high: int,
              leaf: int = LEAF_CHARS) -> np.ndarray:
    """Tokens of text[low:high] from those of its leaves, by leaf start."""
    if high - low <= leaf:
        return coded[low]
    cut = low + (high - low) // 2
    left = join_tree(opened, text, coded, low, cut, leaf)
    right = join_tree(opened, text, coded, cut, high, leaf)
    return join_parts(opened, text, left, right, cut, low, high)


def encode(documents: DataFrame, path: str, column: str = "text", long_chars: int = LONG_CHARS,
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The documents with `ids`, the token ids of the whole text in `column`."""
    documents = documents.drop("ids")
    is_long = F.coalesce(F.length(F.col(column)) > long_chars, F.lit(False))
    short = _encode_short(documents.filter(~is_long), path, column)
    long = documents.filter(is_long).withColumn("__text", F.sha2(F.col(column), 256))
    coded = _encode_long(long.select("__text", F.col(column).alias("text")), path, leaf_chars)
    return short.unionByName(long.join(coded, "__text").drop("__text"))


def _encode_short(documents: DataFrame, path: str, column: str) -> DataFrame:
    carried = documents.columns

    def encoded(batch: pa.RecordBatch) -> Iterator[dict]:
        opened = codec(path)
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = [opened.encode(t) if t else [] for t in part.column(column).to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, bounds[-1])
            values = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            yield {n: part.column(n) for n in carried} | {"ids": values}

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return arrow_map(documents, encoded, f"{kinds}, ids array<int>")


def _encode_long(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """`ids` for each distinct long text, its leaves encoded as rows of their own."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        opened = codec(path)
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part, (fixed, piece) in enumerate(opened.parts(text)):
                for a, b in [(0, len(piece))] if fixed else leaves(len(piece), leaf):
                    yield {"key": [key], "part": [part], "fixed": [fixed], "low": [a],
                           "piece": [piece[a:b]]}

    def coded(batch: pa.RecordBatch) -> Iterator[dict]:
        opened = codec(path)
        for row in batch.to_pylist():
            tokens = [] if row["fixed"] else opened.tokens(row["piece"], row["low"]).ravel()
            yield {n: [v] for n, v in row.items()} | {"tokens": [tokens]}

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        opened, ids = codec(path), []
        for _, part in rows.sort_values(["part", "low"]).groupby("part"):
            text = "".join(part["piece"])
            if part["fixed"].iloc[0]:
                ids.append(np.array([opened.added[text]]))
                continue
            by_start = {
                int(a): np.asarray(t, np.int64).reshape(-1, 3)
                for a, t in zip(part["low"], part["tokens"])
            }
            ids.append(join_tree(opened, text, by_start, 0, len(text), leaf)[:, 2])
        return pd.DataFrame({"__text": [rows["key"].iloc[0]], "ids": [np.concatenate(ids)]})

    kinds = "key string, part int, fixed boolean, low long, piece string"
    pieces = arrow_map(texts.dropDuplicates(["__text"]), cut, kinds).repartition("key", "part", "low")
    return (
        arrow_map(pieces, coded, f"{kinds}, tokens array<long>")
        .groupBy("key")  # one text: as large as the row it becomes
        .applyInPandas(joined, "__text string, ids array<int>")
    )


def decode(frame: DataFrame, path: str, column: str = "ids", to: str = "decoded") -> DataFrame:
    """The frame with the text of the token ids in `column`, special tokens included."""
    frame = frame.drop(to)
    carried = frame.columns

    def decoded(batch: pa.RecordBatch) -> Iterator[dict]:
        opened = codec(path).whole
        # Without a decoder of its own the file's tokens are joined by single spaces.
        plain = opened.decoder is None
        names = np.array([], object)
        if plain:
            size = opened.get_vocab_size(with_added_tokens=True)
            names = np.array([opened.id_to_token(i) for i in range(size)], object)
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            values = part.column(column)
            ids = [np.asarray(v.values if v.is_valid else [], np.int64) for v in values]
            texts = [
                " ".join(names[i]) if plain else opened.decode(i.tolist(), skip_special_tokens=False)
                for i in ids
            ]
            yield {n: part.column(n) for n in carried} | {to: texts}

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return arrow_map(frame, decoded, f"{kinds}, `{to}` string")
