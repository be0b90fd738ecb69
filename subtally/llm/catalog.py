"""The registered queries of this subpackage and their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.llm import bpe, oracles
from subtally.llm.co_training import classify
from subtally.llm.common import hex_digest, read
from subtally.llm.decontamination import decontaminate
from subtally.llm.hard_negatives import mine
from subtally.llm.jaccard_join import near_duplicates
from subtally.llm.license_scan import scan_licenses
from subtally.llm.metric_search import search
from subtally.llm.packing import pack
from subtally.llm.prefix_trie import conversation_trie
from subtally.llm.quality_rules import score_quality
from subtally.llm.substring_dedup import remove_passages
from subtally.llm.suffix_dedup import remove_repeats
from subtally.llm.url_filters import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


#: Host, path and verdict of the rules that `op1_url_filters` applies.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).drop("url")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that also start elsewhere."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", hex_digest(F.col("kept_bytes")).alias("kept_sha256")
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, and digests of the ids and of the decoded text, of every document."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(documents, vocabulary).drop("text"), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_digest(ids).alias("ids_sha256"),
        hex_digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that an earlier document holds."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_passages(documents).select(
        "doc_id", "n_words", "n_removed", hex_digest(F.col("kept_text")).alias("kept_sha256")
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, group of near duplicates and number of links of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"), count_links=True).drop("text_hash")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in a packed sequence."""
    return pack(read(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, likelihood-ratio score and verdict of every document."""
    trusted = read(spark, sf_dir, "labels").filter("quality = 1")
    return score_quality(read(spark, sf_dir, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


def op8_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of both views, calibrated probability and verdict of every document."""
    documents = read(spark, sf_dir, "documents")
    return classify(documents, read(spark, sf_dir, "labels")).select(
        "doc_id", "text_score", "meta_score", "probability", "kept"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives for each of five positives of every hundredth vector."""
    embeddings = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and benchmark items of every document."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(documents, read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        hex_digest(F.array_join("items", ",")).alias("items_sha256"), "contaminated",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the conversations with shared openings."""
    return conversation_trie(read(spark, sf_dir, "conversations"), shared=True).drop("n_words")


def queries() -> dict[str, Query]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_bpe": op3_bpe,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_quality_rules": op7_quality_rules,
        "op8_co_training": op8_co_training,
        "op9_license_scan": op9_license_scan,
        "op10_metric_search": op10_metric_search,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_decontamination": op12_decontamination,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": oracles.url_filters(URL_RULES),
        "op4_substring_dedup": oracles.substring_dedup(),
        "op5_jaccard_join": oracles.jaccard_join(),
        "op9_license_scan": oracles.license_scan(),
        "op10_metric_search": oracles.METRIC_SEARCH,
        "op11_hard_negatives": oracles.HARD_NEGATIVES,
        "op12_decontamination": oracles.DECONTAMINATION,
        "op13_prefix_trie": oracles.PREFIX_TRIE,
    }
