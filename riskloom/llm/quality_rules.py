"""Quality rules: counted rules first, then a hashed word and character n-gram logistic regression with calibrated probabilities.

The model is fitted on a bounded sample of labelled rows; features are shares of hashed words, word pairs and runs of three and four
bytes. Texts are scored in Arrow batches; a document stays when no counted rule rejects it and its probability reaches a fixed threshold.

Defined results: null and empty texts have no words and fail; without labels every document that passes the counted rules stays;
repeated rows repeat their result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, mix64, narrow, text_runs
from riskloom.llm.training import collect_features, fit_platt, labelled_sample, sigmoid

SAMPLE_ROWS = 6_000
BITS = 18
THRESHOLD = 0.5
MIN_WORDS = 50  # fixed values of the counted rules
MAX_REPEATED = 50
SYMBOLS = b"#*$%&|<>"


# ---- counted rules -----------------------------------------------------------------------------------------------------------------


def counted(texts: list[bytes], words: Words) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated runs of three."""
    n = len(texts)
    ends = words.text_ends
    text_of = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[np.concatenate([[0], ends])])
    buf = words.bytes
    space = np.isin(buf, np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
    code_points = text_of(((buf & 0xC0) != 0x80) & ~space)
    symbols = text_of(np.isin(buf, np.frombuffer(SYMBOLS, dtype=np.uint8)))
    lines = np.zeros(n, dtype=np.int64)
    for i, text in enumerate(texts):
        full = [x for x in text.split(b"\n") if x.strip()]
        lines[i] = len(full) - len(set(full))
    return [words.counts, code_points, symbols, lines, repeated_words(words)]


def repeated_words(words: Words, k: int = 3) -> np.ndarray:
    """Per text: words that lie in a run of ``k`` words found twice or more in it."""
    h, owner, n = words.hashes, words.owner, len(words.hashes) - k + 1
    covered = np.zeros(len(h) + 1, dtype=bool)
    if n > 0:
        with np.errstate(over="ignore"):
            acc = owner[:n].astype(np.uint64)
            for i in range(k):
                acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
        inside = np.flatnonzero(owner[:n] == owner[k - 1:])
        order = inside[np.argsort(acc[inside], kind="stable")]
        same = acc[order][1:] == acc[order][:-1]
        twice = np.zeros(n, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for i in range(k):
            covered[i:i + n] |= twice
    return np.diff(np.concatenate([[0], np.cumsum(covered[:-1], dtype=np.int64)])[words.firsts])


# ---- the model ---------------------------------------------------------------------------------------------------------------------

_GROUPS = 4  # words, word pairs, runs of three bytes, runs of four


def _gram_keys(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Coordinates of each feature group, and where those of each text begin and end; no gram reaches over the end of its text."""
    shift, group = np.uint64(64 - BITS), np.uint64(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        h = words.hashes
        begins, ends = words.firsts[:-1], words.firsts[1:]
        yield (h >> shift).astype(np.int64), begins, ends
        pairs = mix64(h[:-1] * np.uint64(3) + h[1:] + group)
        yield (pairs >> shift).astype(np.int64), np.minimum(begins, len(pairs)), np.clip(ends - 1, np.minimum(begins, len(pairs)), None)
        b = words.bytes.astype(np.uint32)
        edges = np.concatenate([[0], words.text_ends])  # a text's own line end is its last byte
        for k in (3, 4):
            n = max(len(b) - k + 1, 0)
            acc = np.zeros(n, dtype=np.uint32)
            for i in range(k):
                acc = acc * np.uint32(0x01000193) + b[i:i + n] * np.uint32(0x9E3779B1 & 0xFFFFFFFF)
            acc ^= acc >> np.uint32(15)
            acc *= np.uint32(0x85EBCA6B)
            begins = np.minimum(edges[:-1], n)
            yield (acc >> np.uint32(32 - BITS)).astype(np.int64), begins, np.maximum(edges[1:] - k + 1, begins)


def _sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ends] - total[begins]


def packed_features(texts: list[bytes]) -> list[bytes]:
    """Per text, (coordinate, share) pairs; each group's shares sum to 1."""
    words = Words(texts, lower=False)
    groups = list(_gram_keys(words))
    out = []
    for i in range(len(texts)):
        at, share = [], []
        for g, (keys, begins, ends) in enumerate(groups):
            got, times = np.unique(keys[begins[i]:ends[i]], return_counts=True)
            at.append(got + (g << BITS))
            share.append(times / max(times.sum(), 1))
        out.append(np.rec.fromarrays([np.concatenate(at).astype(np.int32), np.concatenate(share).astype(np.float32)], names="i,v").tobytes())
    return out


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # one table per feature group
    slope: float
    offset: float

    def probabilities(self, words: Words) -> np.ndarray:
        z = np.zeros(len(words.text_ends))
        for table, (keys, begins, ends) in zip(self.weights, _gram_keys(words)):
            z += _sums(table[keys], begins, ends) / np.maximum(ends - begins, 1)
        return sigmoid(np.round(self.slope * z + self.offset, 9))  # sums of one run end in other digits than those of another


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = 12, rate: float = 0.5, pull: float = 1e-6) -> QualityModel:
    """Adaptive-gradient logistic regression on four fifths of the sample, Platt calibration on the rest."""
    sample = labelled_sample(docs, labels, "quality", F.lit(True), sample_rows)
    rows = [(np.frombuffer(x, dtype=[("i", "<i4"), ("v", "<f4")]), y) for x, y in collect_features(sample, packed_features)]
    size = _GROUPS << BITS
    w, seen, bias, bias_seen = np.zeros(size), np.full(size, 1e-6), 0.0, 1e-6
    fit, held = [r for k, r in enumerate(rows) if k % 5], rows[::5]
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(fit)):
            x, y = fit[k]
            i, v = x["i"], x["v"]
            g = sigmoid(w[i] @ v + bias) - y
            step = g * v + pull * w[i]
            seen[i] += step * step
            w[i] -= rate * step / np.sqrt(seen[i])
            bias_seen += g * g
            bias -= rate * g / np.sqrt(bias_seen)
    z = np.array([w[x["i"]] @ x["v"] for x, _ in held])
    slope, offset = fit_platt(z, np.array([y for _, y in held], dtype=float)) if held else (0.0, 35.0)
    return QualityModel(w.reshape(_GROUPS, -1).astype(np.float32), slope, offset)


def apply_rules(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, probability."""
    rows = narrow(docs, id_col, text_col)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
    table = rows.sparkSession.sparkContext.broadcast(model)  # four tables of 2^18 weights, whatever the input

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_runs(batch.column("text")):
                words = Words(texts, lower=False)
                counts = counted(texts, words)
                failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEATED * counts[0])
                p = table.value.probabilities(words)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), *[pa.array(x) for x in (*counts, failed, ~failed & (p >= threshold), p)]], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double")
