"""License scans by diagonal voting.

Word k-grams of every text are hashed and joined with the positions of the same k-grams in license templates. Hits with the same
difference of positions lie on one diagonal: one place where the template may stand. Diagonals of a text and template that lie close together
are merged (a word more or less moves the rest of a passage to the next diagonal), and the merged span is verified by the share of the template it covers.
Hits are compared word by word in the join, so a hash collision adds nothing.

Labels come from base phrases, which must stand complete, and from license passages, of which ``MIN_COVER`` must stand.

Defined results: null and empty texts have no words, no labels (empty strings, null places) and score 0; repeated rows repeat their result (a text is
known by the hash of its id and words, so a task that runs again names it alike); other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import narrow

K = 3
MIN_COVER = 0.7
NEIGHBOURS = 3  # diagonals this close belong to one passage

# fixed values: words of a text are runs of other characters
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fixed values: phrases and their labels
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# fixed values: passages of public license notices and their labels
PASSAGES = [
    ("licensed under the apache license version 2 0", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache-2"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("it under the terms of the gnu general public license as published by the free software foundation either version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is dedicated to the public domain under cc0 1 0 universal", "cc0"),
]


def word_array(text: Column) -> Column:
    """The words of a text, A-Z lowered."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, BREAKS), lambda w: w != "")


def gram_hashes(words: Column, k: int) -> Column:
    """Hash of every run of ``k`` words. The array is bound once, so it is not made again for each run."""
    runs = F.transform(F.array(words), lambda w: F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))))
    return F.get(runs, F.lit(0))


def _templates(spark: SparkSession, base: list[tuple[str, str]], passages: list[tuple[str, str]], k: int) -> DataFrame:
    """One row per template k-gram: gram words, hash, position, template number, its number of k-grams, label, base flag."""
    rows = []
    for number, (text, label) in enumerate([*base, *passages]):
        words = text.split()
        if len(words) < k:
            raise ValueError(f"a template has {k} words at least: {text}")
        rows += [(words[i:i + k], i, number, len(words) - k + 1, label, number < len(base)) for i in range(len(words) - k + 1)]
    table = spark.createDataFrame(rows, "gram array<string>, place int, template int, n_grams int, label string, base boolean")
    return table.withColumn("gram_hash", F.xxhash64(*[F.col("gram")[i] for i in range(k)]))


def license_hits(docs: DataFrame, base=BASE_PHRASES, passages=PASSAGES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, n_words) and verified spans (row, template, label, base, first_word, cover)."""
    spark = docs.sparkSession
    words = narrow(docs, id_col, text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("row"), word_array(F.col("text")).alias("words"))
    placed = words.withColumn("grams", gram_hashes(F.col("words"), k)).select("row", "words", F.posexplode("grams").alias("pos", "gram_hash"))
    templates = _templates(spark, base, passages, k)
    same = (placed["gram_hash"] == templates["gram_hash"]) & (F.slice("words", F.col("pos") + 1, k) == F.col("gram"))
    hits = placed.join(F.broadcast(templates), same).select("row", "template", "n_grams", "label", "base", "place", (F.col("pos") - F.col("place")).alias("diagonal"))
    votes = hits.groupBy("row", "template", "n_grams", "label", "base", "diagonal").agg(F.collect_set("place").alias("places"))
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    run = F.sum(F.when(F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(by) > NEIGHBOURS) | F.lag("diagonal").over(by).isNull(), 1).otherwise(0)).over(by)
    merged = votes.withColumn("run", run).groupBy("row", "template", "n_grams", "label", "base", "run").agg(
        F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"))
    spans = merged.withColumn("cover", F.col("covered") / F.col("n_grams")).where(F.when(F.col("base"), F.col("cover") == 1).otherwise(F.col("cover") >= MIN_COVER))
    return words, spans.drop("run", "covered", "n_grams")


def scan_licenses(docs: DataFrame, base=BASE_PHRASES, passages=PASSAGES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words, spans = license_hits(docs, base, passages, k, id_col, text_col)
    found = spans.groupBy("row").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("cover").alias("score"))
    counted = words.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"))
    return counted.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"), F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
