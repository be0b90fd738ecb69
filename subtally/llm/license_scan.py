"""License scans: k-gram hashes vote for the offset at which a template lies in a text.

All rolling pairs of words of all texts are joined by hash (and then by the words
themselves) to the positions that such a pair has in the templates. A match votes for the
diagonal "text position minus template position". Neighbouring diagonals (words inserted or
left out) are merged into a span, and a span is verified against the template: what counts
is the longest chain of its matches that goes forward in the template and in the text, so
each template position counts once and only in its order. The share of the template's pairs
in that chain is the coverage. A short phrase counts where its own diagonal covers all of
it, that is, where its words stand consecutively. Only column functions, joins, grouping
and windows are used.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. Defined results: null
and empty texts have no words, no places, empty labels and score 0. Rows equal in id and
text are judged alike, row by row; null ids are kept. Extra columns are carried along,
result columns replace input columns of the same name.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Phrases that give a label wherever they stand.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Opening words of well-known license notices.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files": "mit-notice",
    "licensed under the apache license version 2 0 the license you may not use this file "
    "except in compliance with the license": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "bsd-notice",
    "licensed under a creative commons attribution": "cc-by",
    "all rights reserved": "reserved",
}
#: Diagonals at most so far apart support each other.
SHIFT = 2
#: Share of a template's pairs that a span has to cover.
SHARE = 0.8

_NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _template_pairs(spark, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    rows = [
        (number, label, is_phrase, len(words) - 1, at, words[at], words[at + 1])
        for number, (text, label, is_phrase) in enumerate(
            [(t, n, True) for t, n in phrases.items()] + [(t, n, False) for t, n in templates.items()]
        )
        for words in [text.split()]
        for at in range(len(words) - 1)
    ]
    names = ("template", "label", "phrase", "pairs", "t_at", "t_one", "t_two")
    # An Arrow table becomes a local relation, whose size the planner knows.
    frame = spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))
    return frame.withColumn("gram", F.xxhash64("t_one", "t_two"))


def _in_order(span: Column) -> Column:
    """Length of the longest chain of matches with rising template and text positions.

    `span` is an array of (diagonal, places): at most 2 * SHIFT + 1 diagonals, each with at
    most as many places as the template has pairs.
    """
    matches = F.array_sort(F.flatten(F.transform(span, lambda d: F.transform(
        d["places"], lambda t: F.struct(t.alias("t"), (d["diagonal"] + t).alias("pos"))))))

    def longer(chains, match):
        before = F.filter(chains, lambda c: (c["t"] < match["t"]) & (c["pos"] < match["pos"]))
        n = F.coalesce(F.array_max(F.transform(before, lambda c: c["n"])), F.lit(0)) + 1
        return F.concat(chains, F.array(F.struct(
            match["t"].alias("t"), match["pos"].alias("pos"), n.cast("int").alias("n"))))

    chains = F.aggregate(matches, F.expr("cast(array() as array<struct<t:bigint,pos:bigint,n:int>>)"), longer)
    return F.array_max(F.transform(chains, lambda c: c["n"]))


def scan_licenses(documents: DataFrame, phrases: dict[str, str] = PHRASES,
                  templates: dict[str, str] = TEMPLATES, text: str = "text",
                  row_id: str = "doc_id", share: float = SHARE) -> DataFrame:
    """The documents with word count, places and labels of license phrases and notices."""
    others = [c for c in documents.columns if c not in RESULTS]
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    words = F.array_remove(F.split(lowered, _NOT_A_WORD), "")
    key = [F.col(row_id).alias("__id"), F.xxhash64(F.col(text)).alias("__text")]
    pairs = (
        documents.select(*key, words.alias("words"))
        .filter(F.size("words") > 1)
        .select("__id", "__text", F.posexplode(F.arrays_zip(
            F.col("words").alias("one"), F.expr("slice(words, 2, size(words))").alias("two"))))
        .select("__id", "__text", "pos", F.col("col.one").alias("one"), F.col("col.two").alias("two"))
        .withColumn("gram", F.xxhash64("one", "two"))
    )
    known = _template_pairs(documents.sparkSession, phrases, templates)
    here = ["__id", "__text", "template", "label", "phrase", "pairs"]
    diagonals = (
        pairs.join(known, "gram")
        .filter("one = t_one AND two = t_two")
        .groupBy(*here, (F.col("pos") - F.col("t_at")).alias("diagonal"))
        .agg(F.collect_set(F.col("t_at").cast("long")).alias("places"))
        .withColumns({"diagonal": F.col("diagonal").cast("long"), "votes": F.size("places")})
    )
    near = Window.partitionBy("__id", "__text", "template").orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    span = F.collect_list(F.struct("diagonal", "places")).over(near)
    # The matches of a single diagonal are in order.
    merged = diagonals.withColumn("span", F.when(~F.col("phrase"), span)).withColumn(
        "covered",
        F.when(F.size("span") > 1, _in_order(F.col("span"))).otherwise(F.col("votes")) / F.col("pairs"),
    )
    place = F.col("phrase") & (F.col("votes") == F.col("pairs"))
    found = place | (~F.col("phrase") & (F.col("covered") >= share))
    value = F.when(place, 1.0).when(F.col("phrase"), F.col("votes") / F.col("pairs")).otherwise(F.col("covered"))
    scanned = merged.groupBy("__id", "__text").agg(
        F.count_if(place).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(place, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.max(value).alias("score"),
    )
    counted = documents.select(
        *[F.col(f"`{c}`") for c in others], F.size(words).cast("long").alias("n_words"), *key
    )
    match = counted["__id"].eqNullSafe(scanned["__id"]) & counted["__text"].eqNullSafe(scanned["__text"])
    return counted.join(scanned, match, "left").select(
        *[counted[f"`{c}`"] for c in others],
        counted["n_words"],
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
