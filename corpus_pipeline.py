"""A training corpus from ``documents``: stages of :mod:`riskloom.llm`, one after another, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import encode_decode
from riskloom.llm.common import labels
from riskloom.llm.exact_dedup import drop_exact_duplicates
from riskloom.llm.mixing import mixed_rows
from riskloom.llm.near_dedup import drop_near_duplicates
from riskloom.llm.toxicity import drop_toxic, fit_toxicity
from riskloom.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labelled ones outside its held-out fold."""
    return drop_toxic(docs, fit_toxicity(docs, labels(spark, sf_dir)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five words, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, k=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its source's target takes it, up to three times."""
    return mixed_rows(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text they decode to; one row per row of the mix."""
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("bpe", bpe)]
ORACLE_SQL = None  # the learned stages have no SQL; tests hold every stage against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
