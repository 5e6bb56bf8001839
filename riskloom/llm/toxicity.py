"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-pairs.

Features are present or absent. The learner goes through a bounded sample of labelled documents one by one; every coordinate has its own rate,
and L1 leaves most weights at zero, so the model is a short list of coordinates.

Defined results: null and empty texts have no features and get the score of the bias; an empty label table gives score 0 everywhere;
repeated rows repeat their score; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, crc_fold, mix64, text_runs
from riskloom.llm.training import collect_features, labelled_sample, sigmoid

SAMPLE_ROWS = 16_000  # labelled documents the model is fitted on, at most
BITS = 20
EPOCHS = 3
THRESHOLD = 0.3

_BREAKS = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and the text of each: words, neighbouring words, words one apart."""
    words = Words(texts, breaks=_BREAKS)
    h, owner = words.hashes, words.owner
    keys, owners = [h], [owner]
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            same = owner[:-gap] == owner[gap:]
            keys.append(mix64(h[:-gap] * np.uint64(2 * gap + 1) + (h[gap:] >> np.uint64(1)))[same])
            owners.append(owner[:-gap][same])
    return (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def packed_features(texts: list[bytes]) -> list[bytes]:
    at, owner = features(texts)
    pairs = np.unique((owner << BITS) | at)
    cuts = np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))
    at = (pairs & ((1 << BITS) - 1)).astype(np.uint32)
    return [at[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero coordinates, sorted, with their weights, and the bias."""

    at: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        dense = np.zeros(1 << BITS)
        dense[self.at] = self.weights
        return sigmoid(self.bias + self._sums(texts, dense))

    @staticmethod
    def _sums(texts: list[bytes], dense: np.ndarray) -> np.ndarray:
        at, owner = features(texts)
        hit = np.flatnonzero(dense[at])
        pairs = np.unique((owner[hit] << BITS) | at[hit])  # present or absent
        return np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=len(texts))

    def column(self, text: Column) -> Column:
        """Score of a text column, in Arrow batches."""
        small = (self.at, self.weights, self.bias)

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            table = np.zeros(1 << BITS)
            table[small[0]] = small[1]
            for batch in batches:
                texts = pa.array(batch, pa.string())
                out = [np.empty(0)] + [ToxicityModel._sums(run, table) for _, _, run in text_runs(texts)]
                yield pd.Series(sigmoid(small[2] + np.concatenate(out)), dtype="float64")

        return score(F.coalesce(text.cast("string"), F.lit("")))


def fit_ftrl(rows: list[tuple[bytes, int]], alpha: float = 2.0, beta: float = 1.0, l1: float = 3.0, l2: float = 0.0, epochs: int = EPOCHS) -> ToxicityModel:
    """FTRL-proximal: ``z`` gathers gradients less the proximal pull, ``n`` their squares; the last place is the bias (no L1)."""
    bias = 1 << BITS
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    shrink = np.full(bias + 1, l1)
    shrink[bias] = 0.0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= shrink[i], 0.0, -(zi - np.sign(zi) * shrink[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            x, y = rows[k]
            at = np.append(np.frombuffer(x, dtype=np.uint32).astype(np.int64), bias)
            w = weights(at)
            g = sigmoid(w.sum()) - y
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(bias + 1))
    at = np.flatnonzero(w[:-1])
    if not rows:
        return ToxicityModel(at, w[at], -35.0)
    return ToxicityModel(at, w[at], float(w[-1]))


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 4) == 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learns only from labelled rows that are not held out."""
    sample = labelled_sample(docs, labels, "toxic", ~held_out(F.col("doc_id")), sample_rows)
    return fit_ftrl(collect_features(sample, packed_features))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = docs.select(F.col(id_col).alias("doc_id"), model.column(docs[text_col]).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Rows below the threshold, with their columns."""
    return docs.withColumn("__score", model.column(docs[text_col])).where(F.col("__score") < THRESHOLD).drop("__score")
