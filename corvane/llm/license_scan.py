"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of a text is hashed and joined to the positions of
the same hash in the templates. A match at text word p and template word q is a
vote for the diagonal p - q; votes are counted by diagonal. For base phrases a
diagonal with all votes is a place. For longer templates neighbouring diagonals
(words left out or put in) are merged where their spans meet, and a merged span
is verified: the longest chain of different template k-grams that stand in it in
the template's order must cover enough of the template.

Texts are cut and hashed once. Each row carries one mark that always finds a
partner, so a row without votes is not lost at the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words in a k-gram; diagonals apart that are merged; share of a template that a span must cover.
K, DRIFT, COVER = 2, 3, 0.8
#: Phrases whose every place counts, and their labels (fixed values).
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Notices of the method's own labels (fixed values, from the published license texts).
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-text"),
    ("released under the mit license", "mit-notice"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd-text"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0-notice"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-text"),
    ("this is free and unencumbered software released into the public domain", "unlicense-text"),
]
#: A word: ASCII letters and digits in lower case, and all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))


def _grams(ws: Column) -> Column:
    """Hashes of all rolling k-grams of an array of words, in order."""
    return F.transform(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (K - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(ws, i + j) for j in range(1, K))))


def template_grams(spark: SparkSession, base: list = BASE, notices: list = NOTICES) -> DataFrame:
    """Rows (h, label, is_base, q, size): each template k-gram's hash, its position and the template's k-grams."""
    rows = [(t, label, True) for t, label in base] + [(t, label, False) for t, label in notices]
    made = spark.createDataFrame(rows, "t string, label string, is_base boolean").withColumn("w", words_of(F.col("t"))).withColumn("g", _grams(F.col("w")))
    return made.select("label", "is_base", F.size("g").alias("size"), F.posexplode("g").alias("q", "h"))


def longest_chain(votes: Column) -> Column:
    """Length of the longest chain of an array of struct(q, p), both rising: for each length the least end, word by word."""
    order = F.array_sort(F.transform(votes, lambda v: F.struct(v["q"].alias("q"), (-v["p"]).alias("p"))))  # of one q, the last place first, so that it counts once

    def step(ends, v):
        p = -v["p"]
        below = F.size(F.filter(ends, lambda e: e < p))
        return F.concat(F.slice(ends, F.lit(1), below), F.array(p), F.slice(ends, below + 2, F.greatest(F.size(ends) - below - 1, F.lit(0))))

    return F.size(F.aggregate(order, F.array().cast("array<int>"), step))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", base: list = BASE, notices: list = NOTICES) -> DataFrame:
    """Rows (key, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each input row.

    ``n_base``: places of base phrases; ``first_word`` and ``last_word``: their
    least and greatest start (null if none). Labels are distinct, sorted and
    joined by commas, empty if none. ``score``: the greatest share of a
    template's k-grams that a verified span holds in order, 1 with any base
    place, else 0. Null texts are empty. Repeated rows are rows of their own;
    keys may be null; other columns are not read. Spans of templates that
    overlap count each, and so do equal templates under two labels. Phrases
    have at least two words. An empty table gives no rows.

    The templates are a fixed list of a few hundred k-grams and are broadcast;
    text k-grams that no template has end at that join.
    """
    spark = docs.sparkSession
    mark = spark.range(1).select(F.xxhash64(F.lit("every row")).alias("h"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("boolean").alias("is_base"), F.lit(0).alias("size"), F.lit(0).alias("q"))
    marks = F.broadcast(template_grams(spark, base, notices).select("h", "label", "is_base", "size", "q").union(mark))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), words_of(F.col(text)).alias("w"))
    rows = rows.select("row", "k", F.size("w").alias("n_words"), F.concat(F.array(F.xxhash64(F.lit("every row"))), _grams(F.col("w"))).alias("g"))
    flat = rows.select("row", "k", "n_words", F.posexplode("g").alias("p", "h"))
    votes = flat.join(marks, "h").select("row", "k", "n_words", "label", "is_base", "size", "q", (F.col("p") - 1).alias("p"), (F.col("p") - 1 - F.col("q")).alias("d")).repartition("row")
    one = ["row", "k", "n_words", "label", "is_base", "size"]
    lines = votes.groupBy(*one, "d").agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.collect_list(F.struct("q", "p")).alias("votes"))
    near = Window.partitionBy("row", "label", "is_base", "size").orderBy("d")
    # base phrases: each diagonal by itself; notices: runs of neighbouring ones
    apart = F.col("is_base") | (F.col("d") - F.lag("d").over(near) > DRIFT) | (F.abs(F.col("lo") - F.lag("hi").over(near)) > F.col("size"))
    runs = lines.withColumn("new", F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)).withColumn("run", F.sum("new").over(near))
    spans = runs.groupBy(*one, "run").agg(F.sum("n").alias("n"), F.min("d").alias("d"), F.flatten(F.collect_list("votes")).alias("votes"))
    # only spans with enough votes at all are verified
    held = F.when(F.col("is_base"), F.col("n")).when(F.col("n") >= COVER * F.col("size"), longest_chain(F.col("votes"))).otherwise(0)
    sure = spans.withColumn("share", F.when(F.col("size") > 0, held / F.col("size")).otherwise(0.0))
    sure = sure.withColumn("hit", F.coalesce(F.col("share") >= F.when(F.col("is_base"), 1.0).otherwise(COVER), F.lit(False)) & F.col("label").isNotNull())
    start = F.when(F.col("hit") & F.col("is_base"), F.col("d").cast("long"))
    text_of = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return sure.groupBy("row", "k", "n_words").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        text_of(F.when(F.col("hit") & F.col("is_base"), F.col("label"))).alias("base_labels"), text_of(F.when(F.col("hit"), F.col("label"))).alias("labels"), F.max(F.when(F.col("hit"), F.col("share")).otherwise(0.0)).alias("score"),
    ).select(F.col("k").alias(key), F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
