"""Decontamination against plain Python, on texts that share words, windows and copies."""

import random
import re

import numpy as np
import pytest

from subtally.llm.decontamination import decontaminate
from subtally.llm.fm_index import STEP, FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(texts, items, window):
    """n_words, hit words as spans, and items of each text."""
    grams = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            grams.setdefault(tuple(words[at:at + size]), set()).add(item)
    sizes = {len(g) for g in grams}
    for text in texts:
        words = words_of(text)
        hit, held = set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if tuple(words[at:at + size]) in grams:
                    hit |= set(range(at, at + size))
                    held |= grams[tuple(words[at:at + size])]
        begins = sorted(w for w in hit if w - 1 not in hit)
        spans = [(b, next(e for e in range(b, len(words) + 1) if e not in hit)) for b in begins]
        yield len(words), len(hit), sorted(str(i) for i in held if i is not None), spans


def judged(frame):
    return [(r.n_words, r.n_hit, list(r["items"]), [(s["first"], s["end"]) for s in r.spans])
            for r in sorted(frame.collect(), key=lambda r: r.row)]


def test_index_finds_every_place():
    rng = np.random.default_rng(5)
    for trial in range(60):
        runs = [rng.integers(0, 3, rng.integers(1, 4 * STEP)).astype(np.uint64) << np.uint64(40)
                for _ in range(rng.integers(1, 6))]
        if trial % 3 == 0:
            runs = [runs[0]] * len(runs)
        index = FMIndex(np.concatenate(runs), np.cumsum([0, *map(len, runs)]))
        for size in (1, 2, 5):
            phrases = np.unique(rng.integers(0, 4, (20, size)).astype(np.uint64) << np.uint64(40), axis=0)
            for phrase, low, high in zip(phrases, *index.search(phrases)):
                run, at = index.run_of(index.locate(np.arange(low, high)))
                places = [(r, a) for r, words in enumerate(runs) for a in range(len(words) - size + 1)
                          if (words[a:a + size] == phrase).all()]
                assert sorted(zip(run.tolist(), at.tolist())) == places


@pytest.mark.parametrize("part_windows", [1 << 17, 40])
def test_matches_plain_python(spark, part_windows):
    rng = random.Random(4)
    word = lambda: rng.choice(["Öl", "a", "b", "c7", "D", "ee", "f", "zz", "q"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 4, 9, 14])))) for i in range(12)]
    items += [(3, "x y z w v"), (40, None), (41, ""), (42, "--"), (None, "k l m n"), (9, items[5][1]), (9, items[5][1])]
    texts = [None, "", " \n", "A", "k l M n.k L m\nN", "x-y/z?w"]
    for _ in range(60):
        words = [rng.choice(["other", word()]) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.5:
            words += words_of(rng.choice(items)[1]) + [word()]
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    texts += [texts[20]] * 30 + [" ".join(["other"] * 3000 + words_of(items[2][1]) * 200)]
    rows = [(i, i // 2 if i % 5 else None, t, "x", 7, True) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "row int, doc_id long, text string, n_hit string, `a.b` int, spans boolean")
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    result = decontaminate(frame.repartition(4), bench, window=4, part_windows=part_windows)
    assert judged(result) == list(expected(texts, items, 4))
    first = {r.row: r for r in result.collect()}[1]
    assert first["a.b"] == 7 and first["contaminated"] is False and first["text"] == ""


def test_empty_tables(spark):
    texts = spark.createDataFrame([(0, "some words here")], "row int, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert judged(decontaminate(texts, none)) == [(3, 0, [], [])]
    items = spark.createDataFrame([("q", "words here")], "item_id string, text string")
    assert judged(decontaminate(texts, items)) == [(3, 2, ["q"], [(1, 3)])]
    assert decontaminate(texts.filter("row > 0"), items).collect() == []


def test_text_column_of_a_result_name(spark):
    texts = spark.createDataFrame([(0, "some words here")], "row int, items string")
    items = spark.createDataFrame([("q", "words here")], "item_id string, text string")
    assert judged(decontaminate(texts, items, text="items")) == [(3, 2, ["q"], [(1, 3)])]
