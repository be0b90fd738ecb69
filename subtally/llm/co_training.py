"""Quality classifier by co-training: a text view and a metadata view teach each other.

Both views start from labelled documents. In each round each view scores documents without
label, and those it is confident about join the other view's training set with its verdict.
The two scores are then calibrated together on labelled documents that neither view saw,
and every document gets the calibrated probability of being good (of quality and not toxic).

Two verdicts make `kept`. A document goes if its probability is too low, or if one of its
words is too strong evidence of toxicity: the log ratio of the word's share of toxic and of
good training documents. A single insult in a long good text hardly moves a sum of weights,
so this is a verdict of its own. Both thresholds come from good and bad calibration documents.

The views are fitted in one task on at most `LABELLED_ROWS` labelled and `POOL_ROWS` other
documents, chosen by the hash of their ids; that is the bound of everything held in one
place. All documents are scored, whole texts, in one pass.

Defined results: null and empty texts have no words and are judged by metadata and prior.
Missing metadata columns and null values count as one value of their own. Labels of one
document that differ count as bad; labels with a null id or verdict are ignored. Without
labels of both kinds every score is 0.5 and every document is kept. Repeated rows are judged
row by row, extra columns are carried along, result columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import arrow_map, lists, unused
from subtally.llm.textblocks import BASE, Block, mix, text_blocks, words_of

LABELLED_ROWS = 12_000
POOL_ROWS = 6_000
ROUNDS = 3
CONFIDENT = 0.97
#: Share of the labelled rows kept apart for calibration: one of so many.
CALIBRATION = 4
TEXT_BUCKETS = 1 << 17
#: Training rows that must hold a bucket before it gets a weight.
RARE = 5
META_BUCKETS = 1 << 12
#: Each verdict leaves out at most this share of the good calibration documents.
LOST_SHARE = 0.003
#: Of the bad ones that it then could leave out, this share is given up for a wide margin.
SPARED_SHARE = 0.1
HIGHEST_THRESHOLD = 0.5


#: Bytes of words of letters and digits; everything beyond ASCII counts as a letter.
_ALPHANUMERIC = np.ones(256, bool)
_ALPHANUMERIC[:128] = False
_ALPHANUMERIC[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
#: Shares of words of one shape are told apart down to 2 ** -SHAPE_LEVELS.
SHAPE_LEVELS = 7


def _shapes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of what share of its words has which shape, at least.

    The shape of a word is its last ASCII character, whether it begins with two capitals,
    and whether it repeats the word before it.
    """
    words = words_of(block)
    n = len(words.start)
    text = np.searchsorted(words.first, np.arange(n), "right") - 1
    last = block.data[words.end - 1].astype(np.int64)
    second = block.data[np.minimum(words.start + 1, words.end - 1)]
    capitals = (block.data[words.start] >= 65) & (block.data[words.start] <= 90) & (second >= 65) & (second <= 90)
    again = np.zeros(n, bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (text[1:] == text[:-1])
    shape = np.where(last < 128, last, 0) * 4 + capitals * 2 + again
    found, count = np.unique(text * 512 + shape, return_counts=True)
    text, shape = np.divmod(found, 512)
    level = np.log2(count / words.counts[text]) + SHAPE_LEVELS
    steps = [(text[level >= k], shape[level >= k] * 8 + k) for k in range(SHAPE_LEVELS + 1)]
    key = np.concatenate([k for _, k in steps]).astype(np.uint64)
    return np.concatenate([t for t, _ in steps]), mix((key + np.uint64(1)) * BASE)


def text_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of the distinct words and word shapes of each text of a block."""
    words = words_of(block, _ALPHANUMERIC, fold=True)
    text = np.searchsorted(words.first, np.arange(len(words.start)), "right") - 1
    shaped, shapes = _shapes(block)
    hashes = np.concatenate((words.hash, shapes))
    bucket = (hashes >> np.uint64(64 - TEXT_BUCKETS.bit_length() + 1)).astype(np.int64)
    found = np.unique(np.concatenate((text, shaped)) * TEXT_BUCKETS + bucket)
    return np.divmod(found, TEXT_BUCKETS)


def meta_key(documents: DataFrame) -> Column:
    """Metadata of a document as tokens: language, source, both, and size class."""
    present = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in documents.columns else F.lit("")
               for c in ("lang", "source")}
    size = F.col("n_chars") if "n_chars" in documents.columns else F.lit(None)
    size = F.coalesce(F.floor(F.log2(F.greatest(size.cast("double"), F.lit(1.0)))).cast("string"), F.lit(""))
    tokens = [
        F.concat(F.lit("l="), present["lang"]), F.concat(F.lit("s="), present["source"]),
        F.concat(F.lit("ls="), present["lang"], F.lit("/"), present["source"]), F.concat(F.lit("n="), size),
    ]
    return F.array(*[F.pmod(F.xxhash64(t), F.lit(META_BUCKETS)) for t in tokens])


class View:
    """Logistic regression over sets of buckets, with decay and both classes of equal weight."""

    def __init__(self, buckets: int, steps: int = 150, decay: float = 5e-3, step: float = 0.1):
        self.buckets, self.steps, self.decay, self.step = buckets, steps, decay, step
        self.weights, self.bias = np.zeros(buckets), 0.0

    def score(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, weights=self.weights[bucket], minlength=n) + self.bias

    def fit(self, row: np.ndarray, bucket: np.ndarray, y: np.ndarray) -> View:
        n = len(y)
        used = np.bincount(bucket, minlength=self.buckets) >= RARE
        row, bucket = row[used[bucket]], bucket[used[bucket]]
        weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
        moment, bias_moment = np.zeros(self.buckets), 0.0
        for _ in range(self.steps):
            error = weight * (y - _sigmoid(self.score(row, bucket, n)))
            # Counts of nothing would be integers.
            gradient = np.bincount(bucket, weights=error[row], minlength=self.buckets).astype(float)
            gradient -= self.decay * self.weights
            moment += gradient**2
            bias_moment += error.sum() ** 2
            self.weights += self.step * gradient / (np.sqrt(moment) + 1e-12)
            self.bias += self.step * error.sum() / (np.sqrt(bias_moment) + 1e-12)
        return self


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    text: View
    meta: View
    #: Weights of the two scores, and the constant, of the calibrated log odds.
    mixing: np.ndarray
    threshold: float
    #: Strength of each word as evidence of toxicity, and the strength that rejects a text.
    evidence: np.ndarray
    toxic_threshold: float

    def probability(self, text_score: np.ndarray, meta_score: np.ndarray) -> np.ndarray:
        return _sigmoid(self.mixing[0] * text_score + self.mixing[1] * meta_score + self.mixing[2])

    def toxicity(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """Strongest evidence in each text."""
        most = np.zeros(n)
        np.maximum.at(most, row, self.evidence[bucket])
        return most


def _cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Least score that passes: most bad are caught while at most LOST_SHARE of the good are.

    Between the least good score that has to pass and the bad scores below it, the cut lies
    in the middle of the widest gap that gives up no more than SPARED_SHARE of those bad.
    """
    least = np.sort(good)[int(LOST_SHARE * len(good))]
    below = np.sort(bad[bad < least])[::-1]
    if not len(below):
        return float(least)
    edges = np.concatenate(([least], below[: int(SPARED_SHARE * len(below)) + 1]))
    at = int(np.argmax(edges[:-1] - edges[1:]))
    return float((edges[at] + edges[at + 1]) / 2)


def _evidence(toxic: list[np.ndarray], good: list[np.ndarray]) -> np.ndarray:
    """Log ratio of the shares of toxic and good texts that hold a bucket; 0 if it is rare."""
    held = [np.bincount(np.concatenate([*sets, np.empty(0, np.int64)]).astype(np.int64), minlength=TEXT_BUCKETS)
            for sets in (toxic, good)]
    shares = [np.log((n + 0.5) / (len(sets) + 1)) for n, sets in zip(held, (toxic, good))]
    return np.where(held[0] >= RARE, np.maximum(shares[0] - shares[1], 0.0), 0.0)


def _calibrate(scores: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of y on two scores by Newton steps, with weights not below 0."""
    x = np.column_stack((scores, np.ones(len(y))))
    w = np.array([1.0, 0.0, 0.0])
    for _ in range(30):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        step = np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * (w - [1.0, 0.0, 0.0]))
        w = w + np.clip(step, -1.0, 1.0)
        w[:2] = np.maximum(w[:2], 0.0)
    return w


class _Rows:
    """Bucket sets of the training rows, cut to row subsets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets

    def of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        picked = [self.sets[i] for i in chosen]
        sizes = [len(s) for s in picked]
        return np.repeat(np.arange(len(picked)), sizes), np.concatenate([*picked, np.empty(0, np.int64)]).astype(np.int64)


def co_train(text_sets: list[np.ndarray], meta_sets: list[np.ndarray], y: np.ndarray,
             toxic: np.ndarray | None = None, rounds: int = ROUNDS) -> Model:
    """y: 1 good, 0 bad, -1 without label; toxic: whether a label says so."""
    toxic = np.zeros(len(y), bool) if toxic is None else toxic
    views = (_Rows(text_sets), _Rows(meta_sets))
    labelled, pool = np.flatnonzero(y >= 0), np.flatnonzero(y < 0)
    apart = np.zeros(len(labelled), bool)
    for value in (0, 1):
        apart[np.flatnonzero(y[labelled] == value)[CALIBRATION - 1 :: CALIBRATION]] = True
    train, held = labelled[~apart], labelled[apart] if apart.any() else labelled
    known = [dict(zip(train.tolist(), y[train].tolist())) for _ in views]

    def fitted(v: int) -> View:
        rows = np.array(list(known[v]), np.int64)
        view = View(TEXT_BUCKETS if v == 0 else META_BUCKETS)
        return view.fit(*views[v].of(rows), np.array(list(known[v].values()), float))

    models = [fitted(0), fitted(1)]
    for _ in range(rounds):
        added = 0
        for v, other in ((0, 1), (1, 0)):
            raw = models[v].score(*views[v].of(held), len(held))
            slope = _calibrate(np.column_stack((raw, np.zeros(len(held)))), y[held])
            p = _sigmoid(slope[0] * models[v].score(*views[v].of(pool), len(pool)) + slope[2])
            for at in np.flatnonzero((p >= CONFIDENT) | (p <= 1 - CONFIDENT)).tolist():
                if pool[at] not in known[other]:
                    known[other][int(pool[at])] = float(p[at] >= 0.5)
                    added += 1
        if not added:
            break
        models = [fitted(0), fitted(1)]
    scores = np.column_stack([models[v].score(*views[v].of(held), len(held)) for v in (0, 1)])
    mixing = _calibrate(scores, y[held])
    model = Model(models[0], models[1], mixing, HIGHEST_THRESHOLD, np.zeros(TEXT_BUCKETS), np.inf)
    good, harmful = held[y[held] == 1], held[toxic[held]]
    if len(good):
        odds = scores @ mixing[:2] + mixing[2]
        model.threshold = float(min(HIGHEST_THRESHOLD, _sigmoid(_cut(odds[y[held] == 1], odds[y[held] == 0]))))
    model.evidence = _evidence(
        [text_sets[i] for i in train[toxic[train]]], [text_sets[i] for i in train[y[train] == 1]]
    )
    if len(good) and len(harmful):
        strength = [-model.toxicity(*views[0].of(rows), len(rows)) for rows in (good, harmful)]
        cut = _cut(*strength)
        if (strength[1] < cut).any():
            model.toxic_threshold = -cut
    return model


def _training_rows(documents: DataFrame, labels: DataFrame, labelled: int, pool: int) -> DataFrame:
    """doc_id, y (-1 without label) and whether a label says toxic, of the bounded training sample."""
    ok = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    verdicts = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(
            F.min(ok.cast("int")).alias("y"),
            F.max((F.coalesce(F.col("toxic"), F.lit(0)) != 0).cast("int")).alias("harm"),
        )
    )
    spread = F.xxhash64("doc_id")
    chosen = verdicts.orderBy(spread, "doc_id").limit(labelled)
    others = (
        documents.select("doc_id").filter("doc_id IS NOT NULL").distinct()
        .join(verdicts, "doc_id", "left_anti").orderBy(spread, "doc_id").limit(pool)
        .withColumns({"y": F.lit(-1), "harm": F.lit(0)})
    )
    return chosen.unionByName(others)


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED_ROWS,
        pool: int = POOL_ROWS) -> Model | None:
    """The model, or None without labels of both kinds."""
    sample = _training_rows(documents, labels, labelled, pool)
    # At most labelled + pool ids of 16 bytes are broadcast.
    rows = documents.select("doc_id", "text", meta_key(documents).alias("meta")).join(
        F.broadcast(sample), "doc_id"
    )

    def features(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in text_blocks(batch.column("text")):
            text, bucket = text_features(block)
            bounds = np.searchsorted(text, np.arange(block.rows + 1))
            yield {n: batch.column(n).slice(block.row, block.rows) for n in ("doc_id", "y", "harm", "meta")} | {
                "words": lists(bucket, bounds)
            }

    trained = arrow_map(
        rows.select("doc_id", "y", "harm", "text", "meta"), features,
        "doc_id long, y int, harm int, meta array<long>, words array<long>",
    )

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id").drop_duplicates("doc_id")
        y = group["y"].to_numpy()
        if not {0, 1} <= set(y.tolist()):
            return pd.DataFrame({"part": pd.Series(dtype="int32"), "weights": pd.Series(dtype=object)})
        model = co_train([np.asarray(x) for x in group["words"]], [np.asarray(x) for x in group["meta"]], y,
                         group["harm"].to_numpy() == 1)
        rest = np.array([model.text.bias, model.meta.bias, *model.mixing, model.threshold, model.toxic_threshold])
        weights = [model.text.weights, model.meta.weights, model.evidence, rest]
        return pd.DataFrame({"part": range(len(weights)), "weights": weights})

    # One group of at most labelled + pool rows.
    parts = trained.groupBy().applyInPandas(train, "part int, weights array<double>").collect()
    if not parts:
        return None
    text, meta, evidence, rest = (np.array(w) for _, w in sorted((p.part, p.weights) for p in parts))
    model = Model(View(TEXT_BUCKETS), View(META_BUCKETS), rest[2:5], float(rest[5]), evidence, float(rest[6]))
    model.text.weights, model.text.bias = text, rest[0]
    model.meta.weights, model.meta.bias = meta, rest[1]
    return model


def classify(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED_ROWS,
             pool: int = POOL_ROWS) -> DataFrame:
    """The documents with `text_score`, `meta_score`, `probability` and `kept`."""
    model = fit(documents, labels, labelled, pool)
    results = ("text_score", "meta_score", "probability", "kept")
    carried = [c for c in documents.columns if c not in results]
    plain = documents.select(*[F.col(f"`{c}`") for c in carried])
    if model is None:
        return plain.withColumns({
            "text_score": F.lit(0.0), "meta_score": F.lit(0.0), "probability": F.lit(0.5), "kept": F.lit(True)
        })
    (meta_name,) = unused(plain, "__meta")
    shared = documents.sparkSession.sparkContext.broadcast(model)  # three arrays of fixed length

    def scored(batch: pa.RecordBatch) -> Iterator[dict]:
        fitted = shared.value
        for block in text_blocks(batch.column("text")):
            n = block.rows
            words = text_features(block)
            text = fitted.text.score(*words, n)
            meta_sets = batch.column(meta_name).slice(block.row, n)
            row = np.repeat(np.arange(n), np.asarray(meta_sets.value_lengths()))
            meta = fitted.meta.score(row, np.asarray(meta_sets.flatten()), n)
            p = fitted.probability(text, meta)
            kept = (p >= fitted.threshold) & (fitted.toxicity(*words, n) < fitted.toxic_threshold)
            yield {c: batch.column(c).slice(block.row, n) for c in carried} | {
                "text_score": text, "meta_score": meta, "probability": p, "kept": kept,
            }

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return arrow_map(
        plain.withColumn(meta_name, meta_key(documents)), scored,
        f"{kinds}, text_score double, meta_score double, probability double, kept boolean",
    )
