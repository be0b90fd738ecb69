"""Stages of the pipeline, each against a plain version on its own input."""

import brute
import corpus_pipeline
import pytest
from brute import ODD
from pyspark.sql import functions as F

import __spark_entry__

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """Rows that each stage gets and returns."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return out


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(kept):
    columns = kept[0][1].columns
    assert [name for name, *_ in kept] == list(STAGES)
    assert all(result.columns == columns for _, _, result in kept[:-1])


def test_quality_stage(kept):
    _, before, after = kept[0]
    left = {d for d, _ in pairs(after)}
    assert all(not (brute.counts(t)[5] and d in left) for d, t in pairs(before))


def test_classifier_keeps_clean_documents(spark, sf_dir, kept):
    _, before, after = kept[1]
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0")
    had, has = before.join(good, "doc_id").count(), after.join(good, "doc_id").count()
    assert has >= 0.97 * had


def test_one_of_each_group_stays(kept):
    _, before, after = kept[2]
    rows = pairs(before)
    want = {d for (d, _), (_, c) in zip(rows, brute.groups(rows)) if d == c}
    assert sorted(d for d, _ in pairs(after)) == sorted(want)


def test_passages_go(kept):
    _, before, after = kept[3]
    rows = pairs(before)
    want = {d: (n - m, sha) for (d, _), (n, m, sha) in zip(rows, brute.passages(rows)) if n > m or not m}
    got = {d: t for d, t in pairs(after)}
    assert set(got) == set(want)
    assert all(brute.sha(" ".join(brute.WORD.findall(got[d]))) == want[d][1] for d in got)


def test_packing_covers_all_words(kept):
    _, before, after = kept[4]
    words = {d: len(brute.WORD.findall(t)) for d, t in pairs(before)}
    total = {r.doc_id: r.n for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total == words


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
@pytest.mark.parametrize("name", STAGES)
def test_odd_rows(docs, spark, sf_dir, name, rows):
    frame = docs(rows)
    result = STAGES[name](spark, frame, sf_dir)
    got = result.collect()
    assert len(got) <= max(len(rows), 20) * 20
    if name != "best-fit packing":
        assert result.columns == frame.columns


def test_repeated_rows_are_one_document(docs, spark, sf_dir):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (3, None), (None, text + " more"), (4, "")]
    got = STAGES["n-gram Jaccard join"](spark, docs(rows), sf_dir).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == [("1", text), ("3", ""), ("4", "")]


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
