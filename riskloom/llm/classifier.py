"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network with calibrated temperature.

Words are hashed to buckets; a second stream holds the shape of each word (case, digits, symbols, last byte, same as the word before). Every bucket has a
sparse random index vector; its word vector is the sum of the index vectors around it in the sampled documents. A document is the mean of
its words' vectors and of its shapes' vectors. Vectors, network and temperature are fitted on a bounded sample of labelled rows.

Defined results: null and empty texts pool to zero vectors and get the network's score for those; without labels every score is 0.5; repeated rows
repeat their score; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, crc_fold, mix64, narrow, text_runs
from riskloom.llm.training import collect_features, labelled_sample, sigmoid

SAMPLE_ROWS = 8_000
WORD_BITS, SHAPE_BITS = 14, 10
DIMENSIONS = 32
THRESHOLD = 0.3


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word (cased apart only in its shape) and of its shape."""
    buf = words.bytes
    with np.errstate(over="ignore"):
        upper = np.concatenate([[0], np.cumsum((buf >= 65) & (buf <= 90))])
        digit = np.concatenate([[0], np.cumsum((buf >= 48) & (buf <= 57))])
        other = np.concatenate([[0], np.cumsum((buf < 48) | ((buf > 57) & (buf < 65)) | ((buf > 90) & (buf < 97)) | ((buf > 122) & (buf < 128)))])
        length = words.ends - words.starts
        n_upper, n_digit, n_other = (x[words.ends] - x[words.starts] for x in (upper, digit, other))
        h = words.hashes
        again = np.zeros(len(h), dtype=np.uint64)
        again[1:] = (h[1:] == h[:-1]) & (words.owner[1:] == words.owner[:-1])
        case = np.minimum(n_upper, 1) + (n_upper > 1) + (2 * n_upper > length)
        last = np.where(n_other > 0, buf[words.ends - 1], 0) if len(h) else np.empty(0, dtype=np.int64)
        shape = ((case * 2 + (n_digit > 0)) * 5 + np.minimum(n_other, 4)) * 256 + last
        shape = mix64(shape.astype(np.uint64) * np.uint64(2) + again + np.uint64(1))
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), (shape >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)


def _index_vectors(size: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: four places of each row are +1 or -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((size, DIMENSIONS), dtype=np.float32)
    for _ in range(4):
        out[np.arange(size), rng.integers(0, DIMENSIONS, size)] += rng.choice(np.array([-1, 1], dtype=np.float32), size)
    return out


def random_indexing(streams: list[np.ndarray], size: int, seed: int) -> np.ndarray:
    """Word vectors of length 1: own index vector plus those of both neighbours, over all streams."""
    index = _index_vectors(size, seed)
    total = index.astype(np.float64)
    joined = np.concatenate([np.append(s.astype(np.int64), -1) for s in streams]) if streams else np.empty(0, dtype=np.int64)
    left, right = joined[:-1], joined[1:]
    inside = (left >= 0) & (right >= 0)
    left, right = left[inside], right[inside]
    for d in range(DIMENSIONS):
        total[:, d] += np.bincount(left, weights=index[right, d], minlength=size) + np.bincount(right, weights=index[left, d], minlength=size)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _pooled(bucket: np.ndarray, firsts: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each text's buckets."""
    n = np.diff(firsts)
    out = np.zeros((len(n), vectors.shape[1]), dtype=np.float32)
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(vectors[bucket], firsts[:-1][full], axis=0) / n[full][:, None]
    return out


@dataclass(frozen=True)
class Classifier:
    words: np.ndarray
    shapes: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def inputs(self, words: Words) -> np.ndarray:
        w, s = buckets(words)
        return np.concatenate([_pooled(w, words.firsts, self.words), _pooled(s, words.firsts, self.shapes)], axis=1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(_forward(self.layers, self.inputs(Words(texts, lower=False)))[-1] / self.temperature)


def _forward(layers, x):
    mean, spread, w1, b1, w2, b2 = layers
    x = (x - mean) / spread
    hidden = np.tanh(x @ w1 + b1)
    return x, hidden, hidden @ w2 + b2


def _train(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 1_500, batch: int = 128, rate: float = 0.01, decay: float = 1e-4):
    """Adam on the cross-entropy, from a fixed seed."""
    rng = np.random.default_rng(5)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        xs, h, z = _forward((mean, spread, *params), x[rows])
        d = (sigmoid(z) - y[rows]) / batch
        dh = np.outer(d, params[2]) * (1 - h * h)
        grads = [xs.T @ dh + decay * params[0], dh.sum(axis=0), h.T @ d + decay * params[2], d.sum()]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return (mean, spread, *params)


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least cross-entropy."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(10), 200))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def _packed(texts: list[bytes]) -> list[bytes]:
    words = Words(texts, lower=False)
    w, s = buckets(words)
    both = np.stack([w, s], axis=1).astype(np.uint16)
    return [both[a:b].tobytes() for a, b in zip(words.firsts[:-1], words.firsts[1:])]


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 5) == 0


def fit_classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Learns only from labelled rows that are not held out; a fifth of them sets the temperature."""
    sample = labelled_sample(docs, labels, "quality", ~held_out(F.col("doc_id")), sample_rows)
    rows = [(np.frombuffer(x, dtype=np.uint16).reshape(-1, 2), y) for x, y in collect_features(sample, _packed)]
    words = random_indexing([r[:, 0] for r, _ in rows], 1 << WORD_BITS, 11)
    shapes = random_indexing([r[:, 1] for r, _ in rows], 1 << SHAPE_BITS, 12)
    if not rows:
        wide = 2 * DIMENSIONS
        return Classifier(words, shapes, (np.zeros(wide), np.ones(wide), np.zeros((wide, 1)), np.zeros(1), np.zeros(1), 0.0), 1.0)
    x = np.stack([np.concatenate([words[r[:, 0]].mean(axis=0), shapes[r[:, 1]].mean(axis=0)]) if len(r) else np.zeros(2 * DIMENSIONS) for r, _ in rows])
    y = np.array([y for _, y in rows], dtype=float)
    held = np.arange(len(y)) % 5 == 0
    layers = _train(x[~held], y[~held]) if (~held).any() else _train(x, y)
    return Classifier(words, shapes, tuple(np.asarray(p, dtype=np.float64) for p in layers), fit_temperature(_forward(layers, x[held])[-1], y[held]))


def classify(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = narrow(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # fixed numbers of vectors

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), pa.array(shared.value.scores(texts), pa.float64())], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(work, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
