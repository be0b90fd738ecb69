"""URL filters: host-suffix and path-prefix rules joined by short hash prefixes.

Every distinct (host, path) is expanded into the expressions that a rule could have: each
suffix of the host at a label bound, with each prefix of the path at a length that occurs
among the rules. Expressions and rules meet on the first 8 hex digits of their SHA-256; the
full digest confirms a meeting, and the longest rule that fits decides. Only column
functions and joins are used.

Defined results: a null url, or one without `://`, has an empty host and path and gets the
default verdict. Repeated rows and null ids are judged row by row. Extra columns are
carried along, result columns replace input columns of the same name. Rules with a null
part, or a path that does not begin with `/`, fit nothing; of rules of equal length the one
with the longer host, then `block`, decides. Without rules all urls get the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"
PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _digested(frame: DataFrame, text: Column) -> DataFrame:
    frame = frame.withColumn("digest", F.sha2(text, 256))
    return frame.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per rule text with its rank; equal texts keep the strictest verdict."""
    host = F.translate("host", _UPPER, _LOWER)
    rule = (
        rules.filter("host <> '' AND path LIKE '/%'")
        .select(F.concat(host, "path").alias("rule"), host.alias("rule_host"), "verdict")
        .groupBy("rule")
        .agg(F.max("rule_host").alias("rule_host"), F.max("verdict").alias("verdict"))
    )
    return _digested(rule, F.col("rule"))


def path_lengths(rules: DataFrame) -> list[int]:
    """The distinct lengths of rule paths: at most as many as the longest path has letters."""
    lengths = rules.filter("host <> '' AND path LIKE '/%'").select(F.length("path").alias("n"))
    return sorted(row.n for row in lengths.distinct().collect())


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """The pages with `host`, `path`, `rule` and `verdict`; rules have host, path, verdict."""
    results = ("host", "path", "rule", "verdict")
    others = [c for c in pages.columns if c not in results]
    parted = pages.select(
        *[F.col(f"`{c}`") for c in others], host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    lengths = path_lengths(rules)
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
        if lengths else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    expressions = (
        parted.select("host", "path").distinct()
        .withColumn("suffix", F.explode(suffixes))
        .filter("suffix <> ''")
        .withColumn("prefix", F.explode(prefixes))
    )
    expressions = _digested(expressions, F.concat("suffix", "prefix")).drop("suffix", "prefix")
    prepared = _prepared(rules).withColumnRenamed("digest", "full")
    rank = F.struct(
        F.length("rule").alias("length"), F.length("rule_host").alias("host_length"),
        F.col("verdict"), F.col("rule"),
    )
    best = (
        expressions.join(prepared, "short")
        .filter("digest = full")
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return (
        parted.join(best, ["host", "path"], "left")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
        .select(*[F.col(f"`{c}`") for c in others], *results)
    )
