"""Hard negatives against plain Python, and the certainty of the intervals."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtally.llm import hard_negatives
from subtally.llm.hard_negatives import Intervals, mine, packed, rotated

KIND = "vec_id long, embedding array<double>, label int, rank string, score int, `a.b` int"


def expected(rows, positives=5, negatives=5, low=80, high=100):
    sound = [
        (i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
        if None not in (i, v, label) and None not in v and all(map(math.isfinite, v))
    ]
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (anchor, av, al) in enumerate(sound):
        if anchor % 10:
            continue
        scored = [(-product(av, v), i, label) for m, (i, v, label) in enumerate(sound) if m != n and len(v) == len(av)]
        for minus, positive, _ in sorted(s for s in scored if s[2] == al)[:positives]:
            band = sorted(s for s in scored if s[2] != al and low * -minus <= 100 * -s[0] <= high * -minus)
            out += [(anchor, positive, r + 1, s[1], -minus, -s[0]) for r, s in enumerate(band[:negatives])]
    return sorted(out)


def mined(frame, **how):
    got = mine(frame, F.col("vec_id") % 10 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], KIND)


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_the_product(dim):
    rng = np.random.default_rng(dim)
    anchors = rng.integers(-300, 300, (40, dim)).astype(float)
    rows = np.concatenate([rng.integers(-300, 300, (200, dim)), anchors[:20], np.zeros((2, dim))]).astype(float)
    anchors[3] = 0
    turned = rotated(rows)
    assert np.allclose(turned @ rotated(anchors).T, rows @ anchors.T)
    align = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    low, high = Intervals(anchors).bounds(packed(turned > 0), np.linalg.norm(rows, axis=1), align)
    product = anchors @ rows.T
    assert (low <= product).all() and (product <= high).all()
    if dim == 64:
        whole = np.linalg.norm(anchors, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None]
        assert ((high - low) / np.maximum(2 * whole, 1)).mean() < 0.7


@pytest.mark.parametrize("blocks", [(2048, 1024), (40, 3)])
def test_matches_plain_python(spark, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", blocks[1])
    monkeypatch.setattr(hard_negatives, "_CHUNK", 32)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, -0.1, 0.0, 0.2, 0.4]) for _ in range(6)], rng.randrange(3)) for i in range(150)]
    rows += [(200 + i, rows[10][1], i % 2) for i in range(60)]  # copies of one vector
    rows += [(10, rows[10][1], rows[10][2]), (20, [0.1] * 6, 1), (20, [0.1] * 6, 1), (30, rows[10][1], None)]
    rows += [(300, [0.3, 0.2], 1), (301, [0.3, 0.1], 1), (302, [0.3, 0.15], 2), (310, [], 1), (311, [], 2)]
    rows += [(None, rows[1][1], 1), (40, None, 1), (50, [0.1, None], 1), (60, [math.nan] * 6, 1), (70, [math.inf] * 6, 1)]
    assert mined(_frame(spark, rows).repartition(3)) == expected(rows)
    assert mined(_frame(spark, rows), positives=2, negatives=3, low=50, high=90) == expected(rows, 2, 3, 50, 90)


@pytest.mark.parametrize("rows", [[], [(10, [0.5], 1)], [(10, [0.5], 1), (11, [0.25], 1)], [(10, None, 1)]])
def test_few_rows(spark, rows):
    assert mined(_frame(spark, rows)) == []


def test_scores_beyond_exact_floats(spark):
    rows = [(10, [3e5, 1.0], 1), (11, [3e5, 2.0], 1), (12, [3e5, 1.0], 2), (13, [2.9e5, 7.0], 2)]
    assert mined(_frame(spark, rows)) == expected(rows)
