"""Documents to packed training sequences: quality, near duplicates, passages, packing.

Each stage judges all documents that the stage before it kept, by one operator of
`subtally.llm`, and its decisions take effect. All stages but the last return the columns
of `documents`. Defined results: a table without rows, and null, empty or very long texts,
follow the definitions of the operators; rows with a null id are kept by stages that compare
documents, unless a text without id is a near duplicate of one with an id. Repeated rows of
one id and text are one document from the near-duplicate stage on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.llm.co_training import classify
from subtally.llm.common import read, stored
from subtally.llm.jaccard_join import near_duplicates
from subtally.llm.packing import pack
from subtally.llm.quality_rules import score_quality
from subtally.llm.substring_dedup import remove_passages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counts and the likelihood ratio keep."""
    trusted = read(spark, sf_dir, "labels").filter("quality = 1")
    return score_quality(docs, trusted).filter("kept").select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained views keep."""
    return classify(docs, read(spark, sf_dir, "labels")).filter("kept").select(*docs.columns)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group; documents without words stay."""
    found = near_duplicates(docs)
    others = found.filter("n_shingles > 0 AND NOT (doc_id <=> component_id)").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("text_hash").alias("__text")
    ).distinct()
    keyed = docs.withColumns({
        "__id": F.coalesce("doc_id", F.lit(NO_ID)), "__text": F.xxhash64("text"),
    })
    kept = keyed.join(others, ["__id", "__text"], "left_anti").dropDuplicates(["__id", "__text"])
    return kept.select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of an earlier document; `n_chars` follows the text."""
    cut = remove_passages(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    kept = cut.filter(~changed | (F.col("kept_text") != ""))
    return kept.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every text in a packed sequence."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicate_groups),
    ("substring dedup", passages),
    ("best-fit packing", packing),
]

#: The first stages fit models, which SQL cannot express; tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
