"""URL filters, codec, packing, classifier, license scans and vector search."""

import math
import random

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subtally.llm import bpe
from subtally.llm.catalog import URL_RULES
from subtally.llm.co_training import _cut, classify
from subtally.llm.license_scan import PHRASES, SHARE, SHIFT, TEMPLATES, scan_licenses
from subtally.llm.metric_search import search
from subtally.llm.packing import best_fit, pack, plan
from subtally.llm.url_filters import judge_urls

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

URLS = [
    (1, "https://WWW.Example.org/es/x?y#z", "www.example.org", "/es/x", "example.org/es/", "block"),
    (2, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "http://example.org", "example.org", "", None, "allow"),
    (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "http://a.com/de/#fr", "a.com", "/de/", "com/de/", "block"),
    (6, None, "", "", None, "allow"),
    (7, "no scheme/com/de/", "", "", None, "allow"),
    (8, "x://y://example.org/es/", "y:", "//example.org/es/", None, "allow"),
    (9, "", "", "", None, "allow"),
    (10, "http://com/fr/a/../", "com", "/fr/a/../", "com/fr/", "allow"),
    (None, "http://ÄB.org/É", "Äb.org", "/É", "org/", "allow"),
    (5, "http://a.com/de/#fr", "a.com", "/de/", "com/de/", "block"),
]


def test_urls(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "kept?", 5) for i, u, *_ in URLS],
                                  "page_id long, url string, verdict string, digest int")
    result = judge_urls(pages, rules)
    got = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in result.collect()]
    assert sorted(got, key=repr) == sorted(URLS, key=repr)
    assert result.columns.count("verdict") == 1 and "digest" in result.columns
    assert judge_urls(pages, rules.limit(0)).filter("verdict = 'allow' AND rule IS NULL").count() == len(URLS)
    assert judge_urls(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("long_chars", [10**6, 60], ids=["short", "tree"])
def test_codec(docs, long_chars):
    rnd = random.Random(1)
    rows = ODD + [
        (100, "İstanbul ΣΑΣ éa x\x1cy Don't 'S it's!'s <|endoftext|>a <|ENDOFTEXT|> b"),
        (101, "a" * 4000), (102, "".join(rnd.choice(["th", "e", "in", "'s", "!", "日"]) for _ in range(900))),
        (103, "the" * 200 + "<|startoftext|>" + "!'s" * 100), (104, "e\u0301" * 200),
    ]
    coded = bpe.encode(docs(rows).withColumn("ids", F.lit("clash")), VOCABULARY, "text", long_chars, 40)
    got = {(r.doc_id, r.text): (r.ids, r.decoded) for r in bpe.decode(coded, VOCABULARY).collect()}
    library = Tokenizer.from_file(VOCABULARY)
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[d, t] == (ids, library.decode(ids, skip_special_tokens=False))
    assert coded.count() == len(rows)


def test_packing(docs):
    rows = ODD + [(200 + i, "w " * n) for i, n in enumerate([1, 255, 256, 257, 2047, 2048, 2049, 5000])]
    got = pack(docs(rows), group_pieces=5).collect()
    words = {}
    for d, t in rows:
        words[d] = words.get(d, 0) + len(brute.WORD.findall(t or ""))
    total, bins = {}, {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        if r.length:
            bins.setdefault((r.sequence, r.capacity), []).append((r.offset, r.length))
    assert total == words
    assert len({s for s, _ in bins}) == len(bins)
    for (_, capacity), parts in bins.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity and (capacity == 256 or end > capacity // 2)


def test_plan_is_cheapest_of_its_openings():
    rnd = np.random.default_rng(1)
    lengths = np.sort(rnd.integers(1, 1000, 300))[::-1]
    capacities = (256, 512, 1024)
    _, final = plan(lengths, capacities, 32)
    price = final.sum() + 32 * len(final)
    for opening in capacities:
        _, used = best_fit(lengths, opening, capacities)
        sizes = np.array(capacities)[np.searchsorted(capacities, used)]
        assert price <= sizes.sum() + 32 * len(sizes)


def test_classifier_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    rows = classify(docs, labels.filter(half == 0)).join(labels.filter(half == 1), "doc_id").collect()
    kept = {(q, t): [r.kept for r in rows if (r.quality, r.toxic) == (q, t)] for q in (0, 1) for t in (0, 1)}
    share = {k: sum(v) / len(v) for k, v in kept.items() if v}
    assert share[1, 0] >= 0.98 and share[0, 0] <= 0.1 and share[1, 1] <= 0.7


def test_classifier_leaves_out_plain_insults(spark, sf_dir):
    """Held-out toxic documents of quality with a word that good ones never hold."""
    folder = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    words = "trash|pathetic|idiot|disgusting|worthless|clown|loser|scum|stupid|moron"
    rows = classify(docs, labels.filter(half == 0)).join(labels.filter(half == 1), "doc_id")
    rows = rows.withColumn("plain", F.lower("text").rlike(rf"\b({words})\b")).collect()
    plain = [r.kept for r in rows if r.quality and r.toxic and r.plain]
    good = [r.kept for r in rows if r.quality and not r.toxic]
    assert len(plain) > 80 and sum(plain) <= 0.1 * len(plain), (sum(plain), len(plain))
    assert sum(good) >= 0.98 * len(good), (sum(good), len(good))


def test_cut_looks_at_both_classes():
    good = np.arange(10.0, 1010.0)
    assert _cut(good, np.array([1.0, 2.0])) == 7.5  # three of 1,000 good ones may go
    assert _cut(good, np.array([1.0, 12.0])) == 12.5
    assert _cut(good[:5], np.array([8.0])) == _cut(good[:50], np.array([8.0])) == 9.0


def test_classifier_without_labels(docs, spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    result = classify(docs(ODD), labels)
    assert result.filter("kept AND probability = 0.5").count() == len(ODD)


def test_classifier_on_odd_rows(docs, spark):
    rows = ODD + [(300 + i, f"fine words number {i} " * 5) for i in range(30)]
    rows += [(400 + i, f"BAD!! WORDS!! {i} " * 5) for i in range(30)]
    labels = spark.createDataFrame(
        [(d, int(d < 400), None) for d, _ in rows if d and d >= 300] + [(7, None, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = classify(docs(rows).drop("source"), labels).collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id and 300 <= r.doc_id < 400)
    assert not any(r.kept for r in got if r.doc_id and r.doc_id >= 400)


def test_licenses(docs):
    import re

    rows = ODD + [
        (500, "The MIT License. mit-license, Apache  License; GNU General\nPublic, License general public"),
        (501, "Redistribution and use in source and (binary) forms, with or without any modification, are "
              "permitted provided that the following conditions are met:"),
        (502, "mit\u00e9 license mit 0license MIT LICENSE"), (503, "ALL RIGHTS RESERVED"),
    ]
    got = scan_licenses(docs(rows)).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = []
    for d, t in rows:
        w = word.findall(brute.lower(t))
        places = [(i, n) for p, n in PHRASES.items() for i in range(len(w))
                  if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        want.append((d, len(w), len(places), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted({n for _, n in places}))))
    assert sorted([tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
                   for r in got], key=repr) == sorted(want, key=repr)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[501] == "bsd-notice" and labels[503] == "reserved" and labels[500] == "apache,gpl,mit"


def chain_share(words: list[str], template: list[str], shift: int) -> float:
    """Best share of template pairs that stand in order on diagonals around one diagonal."""
    hits = [(t, p) for t in range(len(template) - 1) for p in range(len(words) - 1)
            if words[p : p + 2] == template[t : t + 2]]
    best = 0
    for middle in {p - t for t, p in hits}:
        length: dict = {}
        for t, p in sorted(hits):
            if abs(p - t - middle) <= shift:
                length[t, p] = 1 + max((n for (u, q), n in length.items() if u < t and q < p), default=0)
        best = max(best, *length.values())
    return best / (len(template) - 1)


def test_license_spans_hold_the_template_once_and_in_order(docs):
    rnd = random.Random(9)
    full = [t.split() for t in TEMPLATES]
    rows = [(1, "all rights all rights"), (2, "rights reserved all rights"), (3, "all rights reserved"),
            (4, "licensed under a licensed under a licensed under a creative")]
    for i in range(60):
        words = list(rnd.choice(full))
        for _ in range(rnd.randint(0, 3)):
            at, n = rnd.randrange(len(words)), rnd.randint(1, 3)
            words[at:at] = rnd.choice([words[at : at + n], ["x"] * n])
            del words[(at := rnd.randrange(len(words))) : at + rnd.randint(0, 2)]
        rows.append((10 + i, " ".join(words)))
    for r in scan_licenses(docs(rows), phrases={"no such": "none"}).collect():
        words = dict(rows)[r.doc_id].split()
        share = {n: chain_share(words, t.split(), SHIFT) for t, n in TEMPLATES.items()}
        assert r.labels == ",".join(sorted(n for n, x in share.items() if x >= SHARE)), r.doc_id
        assert r.score == max(share.values()), r.doc_id


def top(rows, k=5):
    kept = sorted({(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
                   if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, v in kept:
        if i % 50 == 0:
            score = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in kept if j != i and len(w) == len(v))
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(score[:k])]
    return sorted(out)


@pytest.mark.parametrize("pages", [2048, 3])
def test_vector_search(spark, monkeypatch, pages):
    monkeypatch.setattr("subtally.llm.metric_search.PAGE_ENTRIES", pages)
    monkeypatch.setattr("subtally.llm.metric_search.QUERY_BLOCK", 2)
    monkeypatch.setattr("subtally.llm.metric_search.NODES", 6)
    rnd = random.Random(2)
    centres = [[rnd.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in rnd.choice(centres)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [rows[50], rows[50]]
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] + [0.0] * 7), (None, rows[0][1]),
             (2150, [float("inf")] * 8), (2200, [0.5, 0.5]), (2201, [0.1, 0.2]), (2250, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    floats = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = [tuple(r) for r in search(frame, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == top(floats)
    assert search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
