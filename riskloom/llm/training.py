"""Labelled rows for the classifiers: a bounded sample, chosen by hash, with features made on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.llm.common import narrow, text_runs


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, label of at most ``limit`` labelled documents: those whose id hashes lowest.

    ``usable`` is a condition on ``doc_id``. A document labelled more than once has its largest label; null labels and null ids count as not labelled.
    """
    marks = labels.select(c(id_col).alias("doc_id"), c(label).cast("int").alias("label")).where(usable & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(limit)
    return narrow(docs, id_col, text_col).join(F.broadcast(marks), "doc_id")  # at most ``limit`` rows


def lowest_hashes(df: DataFrame, hash_col: str, limit: int) -> int:
    """The bound below which at most ``limit`` rows (nearly as many, if there are more) have their 64-bit hash.

    Rows are counted by the hash's leading bits, 4,096 counts a round, and the group that goes past the limit is counted again by its next bits,
    so no task merges the chosen rows. Rows of equal hashes are taken or left together. The bound is above every hash if all rows fit.
    """
    low, taken, rows = -(1 << 63), 0, df.select(c(hash_col).alias("h"))
    for shift in range(52, -1, -12):
        counts = {r["b"]: r["n"] for r in rows.groupBy(F.shiftright("h", shift).alias("b")).agg(F.count("*").alias("n")).collect()}
        past = None
        for b in sorted(counts):
            if taken + counts[b] > limit:
                past = b
                break
            taken += counts[b]
        if past is None:
            return (1 << 63) - 1 if shift == 52 else low
        low = past << shift
        if taken >= 0.9 * limit:
            break
        rows = rows.where(F.shiftright("h", shift) == past)
    return low


def collect_features(sample: DataFrame, encode: Callable[[list[bytes]], list[bytes]]) -> list[tuple[bytes, int]]:
    """Features (packed by ``encode``, on the executors) and labels of the sample, in the order of the ids' hashes.

    Repeated rows of one document count once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([part.column("h"), pa.array(encode(texts), pa.binary()), part.column("label")], ["h", "x", "label"])

    rows = sample.select(F.xxhash64("doc_id").alias("h"), "text", "label").mapInArrow(work, "h long, x binary, label int").toArrow()
    found = {h: (x, y) for h, x, y in sorted(zip(*[col.to_pylist() for col in rows.columns]), key=lambda r: r[:2])}
    return [found[h] for h in sorted(found)]


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that make ``sigmoid(slope * z + offset)`` a probability of ``y`` (Newton, targets pulled in by one row)."""
    n1, n0 = y.sum(), (1 - y).sum()
    if n1 == 0 or n0 == 0:
        return 1.0, 0.0
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)])
    for _ in range(steps):
        p = sigmoid(w @ x)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - t))
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])
