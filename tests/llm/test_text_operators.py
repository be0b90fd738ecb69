"""Operators on texts against brute force, on given tables and on odd rows."""

import random

import brute
import duckdb
import pyarrow as pa
import pytest
from brute import ODD

from subtally.llm import suffix_dedup
from subtally.llm.co_training import classify
from subtally.llm.jaccard_join import _Sets, jaccard_join, near_duplicates
from subtally.llm.license_scan import scan_licenses
from subtally.llm.quality_rules import score_quality
from subtally.llm.substring_dedup import difference_cover, remove_passages
from subtally.llm.suffix_dedup import remove_repeats, repeated_strings


def near_copies(seed: int, n: int = 120) -> list[tuple]:
    """Copies with a few words changed, shared passages, exact copies and short texts."""
    rnd = random.Random(seed)
    pool = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(pool) for _ in range(rnd.randint(60, 160))] for _ in range(8)]
    passage = [rnd.choice(pool) for _ in range(75)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
            words[rnd.randrange(len(words))] = rnd.choice(pool)
        if rnd.random() < 0.3:
            at = rnd.randrange(len(words))
            words[at:at] = passage[rnd.randint(0, 20) :]
        if rnd.random() < 0.2:
            words = words[: rnd.randint(0, 12)]
        rows.append((i, rnd.choice([" ", "\n"]).join(words)))
    return rows


def collected(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("rows", [near_copies(1), near_copies(2), ODD, []], ids=["one", "two", "odd", "none"])
def test_passages(docs, rows):
    got = collected(remove_passages(docs(rows)), "doc_id", "n_words", "n_removed", "kept_text")
    want = [(d, *r) for (d, _), r in zip(rows, brute.passages(rows))]
    assert sorted([(d, n, m, brute.sha(k)) for d, n, m, k in got], key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("period", [1, 2, 5, 31, 40])
def test_every_difference_is_covered(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_removed_runs_and_extra_columns(docs):
    shared = " ".join(f"s{i}" for i in range(60))
    frame = remove_passages(docs([(1, f"a {shared} b"), (2, f"c d {shared} e")]))
    row = frame.filter("doc_id = 2").first()
    assert (row.removed, row.kept_text, row.lang, row.n_removed) == ([2, 62], "c d e", "en", 60)


@pytest.mark.parametrize("rows", [near_copies(3, 60), ODD, []], ids=["copies", "odd", "none"])
def test_repeats(docs, rows):
    frame = remove_repeats(docs(rows))
    got = collected(frame, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes")
    got = sorted([(*r[:4], brute.sha(bytes(r[4]))) for r in got], key=repr)
    want = [(d, *r) for (d, _), r in zip(rows, brute.repeats([t for _, t in rows]))]
    assert got == sorted(want, key=repr)


def test_hot_anchor_is_counted(docs, monkeypatch):
    monkeypatch.setattr("subtally.llm.suffix_dedup.BLOCK_CONTEXTS", 3)
    rows = near_copies(4, 60)
    got = collected(remove_repeats(docs(rows)), "doc_id", "n_removed", "n_spans")
    want = [(d, *r[1:3]) for (d, _), r in zip(rows, brute.repeats([t for _, t in rows]))]
    assert got == sorted(want, key=repr)


def test_interval_expansion_against_counting():
    rnd = random.Random(5)
    for _ in range(40):
        letters, length = rnd.choice([b"ab", b"abcd", bytes(range(256))]), rnd.choice([3, 8, 20])
        base = [bytes(rnd.choice(letters) for _ in range(60)) for _ in range(3)]
        texts = [b"".join(rnd.choice(base)[rnd.randint(0, 30) :] for _ in range(3)) for _ in range(6)]
        count = {}
        for t in texts:
            for i in range(len(t) - length + 1):
                count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
        want = [[count[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]
        assert [x.tolist() for x in repeated_strings(texts, length)] == want


@pytest.mark.parametrize("rows", [near_copies(6), near_copies(7, 200), ODD, []], ids=["one", "two", "odd", "none"])
def test_groups(docs, rows):
    got = collected(near_duplicates(docs(rows)), "doc_id", "n_shingles", "component_id")
    want = [(d, *r) for (d, _), r in zip(rows, brute.groups(rows))]
    assert got == sorted(want, key=repr)


def test_groups_of_long_lists(docs, monkeypatch):
    """Every list long, blocks of three and a tiny order: all go by pivots and blocks."""
    for name, value in {"SHORT_LIST": 2, "BLOCK_SETS": 3, "ORDER_SHARE": 1, "PART_SETS": 8}.items():
        monkeypatch.setattr(f"subtally.llm.jaccard_join.{name}", value)
    rows = near_copies(8, 150)
    got = collected(near_duplicates(docs(rows)), "doc_id", "n_shingles", "component_id")
    want = [(d, *r) for (d, _), r in zip(rows, brute.groups(rows))]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("tokens", [1 << 18, 300], ids=["one block", "blocks"])
@pytest.mark.parametrize("rows", [near_copies(9, 150), ODD, []], ids=["copies", "odd", "none"])
def test_all_links(docs, monkeypatch, rows, tokens):
    """Every link between different texts, also within known groups, and their number."""
    monkeypatch.setattr("subtally.llm.jaccard_join.LINK_TOKENS", tokens)
    monkeypatch.setattr("subtally.llm.jaccard_join.LINK_COLUMNS", 64)
    monkeypatch.setattr("subtally.llm.jaccard_join.SHORT_LIST", 4)
    sets = [brute.shingle_set(t) for _, t in rows]
    close = [[bool(x & y) and 100 * len(x & y) >= 75 * len(x | y) for y in sets] for x in sets]
    got = collected(near_duplicates(docs(rows), count_links=True), "doc_id", "n_links")
    want = [(d, sum(near) - near[i]) for i, ((d, _), near) in enumerate(zip(rows, close))]
    assert got == sorted(want, key=repr)
    links, members = jaccard_join(docs(rows))
    names = {}
    for r in members.filter("set IS NOT NULL").collect():
        names.setdefault(r.set, []).append(r.doc_id)
    found = [(r.a, r.b) for r in links.collect()]
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    assert all(r.copies_a == len(names[r.a]) and r.copies_b == len(names[r.b]) for r in links.collect())
    pairs = {frozenset((d, e)) for a, b in found for d in names[a] for e in names[b]}
    assert pairs == {frozenset((rows[i][0], rows[j][0])) for i in range(len(rows)) for j in range(i)
                     if close[i][j] and sets[i] != sets[j]}


def test_counts(docs, spark, sf_dir):
    rows = ODD + [(100, "a b\na b\n\n \nc\nc\na b"), (101, "x|y <b> 100% #1"), (102, "é ü\nß")]
    rows += [(1000 + d, t) for d, t in duckdb.sql(
        f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' LIMIT 60").fetchall()]
    labels = spark.createDataFrame([(7, 1), (None, 1)], "doc_id long, quality int")
    frame = score_quality(docs(rows), labels)
    got = collected(frame, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((d, *brute.counts(t)) for d, t in rows), key=repr)
    assert frame.filter("base_failed AND kept").count() == 0


def test_quality_keeps_clean_and_finds_junk(spark, sf_dir):
    """Fitted on half of the labels, judged on the other half."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = score_quality(docs, labels.filter("quality = 1 AND doc_id % 2 = 0"))
    rows = scored.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_string_arrays_stay_whole():
    from subtally.llm.textblocks import text_blocks

    column = pa.array(["ab", None, "", "cde"]).slice(1)
    assert [bytes(b.data) for b in text_blocks(column)] == [b"cde"]


def test_extra_columns_may_have_any_name(spark, sf_dir):
    """Names that the operators use inside, and dots, survive with their values."""
    names = ["d", "r", "__doc", "__row", "__ranges", "__whole", "__meta", "a.b"]
    rows = [(i, "one two three " * 40, "en", "s", 3, *[f"{n}{i}" for n in names]) for i in range(4)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for result in (
        remove_repeats(frame), remove_passages(frame), score_quality(frame, labels.filter("quality = 1")),
        classify(frame, labels), scan_licenses(frame),
    ):
        got = {r.doc_id: tuple(r[n] for n in names) for r in result.collect()}
        assert got == {i: tuple(f"{n}{i}" for n in names) for i in range(4)}


def test_classifier_with_few_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    few = labels.filter("quality = 1").limit(3).unionByName(labels.filter("quality = 0").limit(3))
    assert classify(docs, few).count() == docs.count()


def test_quality_score_is_the_mean_log_ratio(spark):
    """Against plain Python over the texts' own buckets, and the verdict by the threshold."""
    import numpy as np

    from subtally.llm import quality_rules as q
    from subtally.llm.textblocks import text_blocks

    texts = ["a b c " * 10, "a b d " * 12, "x y z " * 9, "B c a", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    trusted = spark.createDataFrame([(0,), (1,), (0,), (77,), (None,)], "doc_id long")
    grams = []
    for text in texts:
        (block,) = text_blocks(pa.array([text]))
        grams.append(q.gram_buckets(block)[1].tolist())
    raw, target = np.zeros(q.BUCKETS), np.zeros(q.BUCKETS)
    for i, buckets in enumerate(grams):
        for bucket in buckets:
            raw[bucket] += 1
            target[bucket] += i in (0, 1)
    smooth = lambda c: np.log((c + q.SMOOTHING) / (c.sum() + q.SMOOTHING * q.BUCKETS))
    ratio = smooth(target) - smooth(raw)
    for row in score_quality(docs, trusted, threshold=0.0).collect():
        buckets = grams[row.doc_id]
        assert row.score == (pytest.approx(np.mean(ratio[buckets])) if buckets else None)
        assert row.kept == (not row.base_failed and row.score >= 0)


def test_near_copies_in_different_groups_are_not_compared_as_rows_of_pairs(docs, monkeypatch):
    """A family whose members are nearly, but seldom, linked: rows follow its sets, not its pairs."""
    rnd = random.Random(7)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(90):
        words = list(base)
        for k, at in enumerate(rnd.sample(range(5, 95), 2)):
            words[at] = f"c{i}_{k}"
        rows.append((i, " ".join(words)))
    compared = []
    verified = _Sets.verified
    monkeypatch.setattr(_Sets, "verified", lambda self, pairs: compared.append(pairs.count()) or verified(self, pairs))
    got = collected(near_duplicates(docs(rows)), "doc_id", "n_shingles", "component_id")
    want = [(d, *r) for (d, _), r in zip(rows, brute.groups(rows))]
    assert got == sorted(want, key=repr)
    assert sum(compared) <= 10 * len(rows)


def test_strings_with_a_short_common_piece_stay_out_of_the_blocks(docs, monkeypatch):
    """An anchor that occurs again is not enough: half of what is beside it must do so, too."""
    rnd = random.Random(11)
    own = lambda: "".join(rnd.choice("abcdefgh") for _ in range(350))
    shared = own()[:200]
    rows = [(i, own() + shared + own()) for i in range(30)]
    met = []
    blocks = suffix_dedup._in_blocks
    monkeypatch.setattr(suffix_dedup, "_in_blocks", lambda c, *a: met.append(c.count()) or blocks(c, *a))
    assert {r.n_removed for r in remove_repeats(docs(rows)).collect()} == {0}
    assert met == [0]


def test_a_copied_context_is_found_once(spark):
    """Its copies are removed whole; only what is no copy needs its strings."""
    rnd = random.Random(12)
    text = bytes(rnd.randrange(97, 123) for _ in range(420))
    rows = [(1, 10, 3, text), (1, 20, 1, text[5:] + b"#")]
    contexts = spark.createDataFrame(rows, "hash long, content long, copies long, bytes binary")
    found = suffix_dedup._by_counting(contexts, 400).collect()
    assert sorted((r.content, r.first) for r in found) == [(20, i) for i in range(16)]
