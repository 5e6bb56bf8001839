"""Hard negatives by a secondary-sort shuffle.

Anchors and rows are scored against each other in blocks: a block of at most ``ANCHORS`` anchors is broadcast, and each Arrow batch of rows is multiplied with
it. A pair's key packs (anchor, descending score, positive before negative, id) into bytes; pairs are partitioned by anchor and sorted by key within the
partitions by the shuffle (``repartition`` and ``sortWithinPartitions``, the DataFrame form of repartitionAndSortWithinPartitions). An iterator then reads each anchor's
pairs in falling score order: a positive opens a window, negatives that come while a window is open are given to it, and a window closes when it is full or
the scores have left it. No anchor's pairs are ever held.

What travels is bounded without losing a result. A first shuffle finds the positives: of the rows with the anchor's label, each task can
only contribute its own first ``positives`` ones. Their scores are the windows, so in the second shuffle each task sends only its own first ``negatives`` rows of each
window. Both are exact, since the first rows of a whole are among the first rows of its parts.

Defined results: rows without an id, label or vector, or with a missing or non-finite component, take no part; a shorter vector counts as if it ended in zeros;
components beyond 2^26 after scaling count as 2^26; a row that is there several times counts once; an anchor id with several rows is the smallest (label, vector) of them, and
its other rows are no partners of it; a window of a positive below zero is empty; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.llm.common import ship_package
from riskloom.session import materialize

ANCHORS = 4_096  # of one broadcast block: 2 MB at 64 dimensions
LARGEST = 1 << 26
_SIGN = 1 << 63
_FLIP = (1 << 64) - 1
_PAIR = "key binary, anchor_id long"


def pack(anchor: int, score: int, negative: bool, row: int) -> bytes:
    """Bytes that sort by anchor, falling score, positives first, id."""
    return struct.pack(">QQBQ", anchor + _SIGN, _FLIP - (score + _SIGN), negative, row + _SIGN)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, row = struct.unpack(">QQBQ", key)
    return anchor - _SIGN, _FLIP - score - _SIGN, bool(negative), row - _SIGN


def whole_vectors(table: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None) -> DataFrame:
    """vec_id, label, vector: rows that take part, with components floor(scale * x)."""
    v = F.transform(c(vector_col), lambda x: x.cast("double"))
    usable = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = table.where(c(id_col).isNotNull() & c(label_col).isNotNull() & c(vector_col).isNotNull()).where(usable)
    bounded = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    return rows.select(c(id_col).cast("bigint").alias("vec_id"), (c(label_col) if label is None else label).cast("bigint").alias("label"), bounded.alias("vector"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` components, cut or filled with zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at < width
    out[row[inside], at[inside]] = flat[inside]
    return out


def inner_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact whole-number products; in floating point where all sums stay below 2^53."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    if float(np.abs(anchors).max()) * float(np.abs(rows).max()) * anchors.shape[1] < 2.0**53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


class _Best:
    """The first ``most`` of one anchor's window in falling score, then id: what one task can contribute."""

    def __init__(self, most: int):
        self.most = most
        self.held: list[tuple[int, int]] = []  # (-score, id), sorted

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.held) == self.most and len(scores):
            near = -scores <= self.held[-1][0]
            scores, ids = scores[near], ids[near]
        if len(scores) > 4 * self.most:
            edge = -np.partition(-scores, self.most - 1)[self.most - 1]
            # ties at the edge are told apart by id; equal ids count once, so look at all of them
            near = scores >= edge
            if len(np.unique(ids[near])) >= self.most:
                scores, ids = scores[near], ids[near]
        self.held = sorted({*self.held, *zip((-scores).tolist(), ids.tolist())})[:self.most]


def _positive_pairs(rows: DataFrame, block, most: int) -> DataFrame:
    """Packed pairs of anchors with rows of their label."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, _ = block.value
        best = [_Best(most) for _ in ids]
        by_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
        for batch in batches:
            row_ids, row_labels = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label"))
            matrix = _matrix(batch.column("vector"), vectors.shape[1])
            for label in np.unique(row_labels).tolist():
                if label in by_label:
                    mine = np.flatnonzero(row_labels == label)
                    scores = inner_products(vectors[by_label[label]], matrix[mine])
                    for k, a in enumerate(by_label[label].tolist()):
                        other = row_ids[mine] != ids[a]
                        best[a].add(scores[k][other], row_ids[mine][other])
        pairs = [(pack(int(ids[a]), -s, False, i), int(ids[a])) for a, b in enumerate(best) for s, i in b.held]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.int64())], ["key", "anchor_id"])

    return rows.mapInArrow(work, _PAIR)


def _negative_pairs(rows: DataFrame, block, most: int, percent: int) -> DataFrame:
    """Packed pairs of anchors with rows of other labels that lie in a window of the anchor."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, windows = block.value
        open_for = [sorted({s for s in windows.get(i, ()) if s >= 0}) for i in ids.tolist()]
        best = [{s: _Best(most) for s in scores} for scores in open_for]
        asked = np.array([a for a, scores in enumerate(open_for) if scores], dtype=np.int64)
        for batch in batches if len(asked) else ():
            row_ids, row_labels = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label"))
            matrix = _matrix(batch.column("vector"), vectors.shape[1])
            for first in range(0, len(asked), 256):
                some = asked[first:first + 256]
                scores = inner_products(vectors[some], matrix)
                for k, a in enumerate(some.tolist()):
                    unlike = (row_labels != labels[a]) & (row_ids != ids[a]) & (100 * scores[k] >= percent * open_for[a][0]) & (scores[k] <= open_for[a][-1])
                    at = np.flatnonzero(unlike)
                    if len(at):
                        mine, theirs = scores[k][at], row_ids[at]
                        for top, held in best[a].items():
                            inside = (mine <= top) & (100 * mine >= percent * top)
                            held.add(mine[inside], theirs[inside])
        pairs = {(pack(int(ids[a]), -s, True, i), int(ids[a])) for a, held in enumerate(best) for b in held.values() for s, i in b.held}
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.int64())], ["key", "anchor_id"])

    return rows.mapInArrow(work, _PAIR)


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor_id").sortWithinPartitions("key")


def first_positives(keys: Iterator[bytes], most: int) -> Iterator[tuple[bytes, int]]:
    """The first pairs of each anchor of a sorted stream; equal pairs count once."""
    at, n, last = None, 0, None
    for key in keys:
        if key == last:
            continue
        last = key
        if key[:8] != at:
            at, n = key[:8], 0
        if n < most:
            n += 1
            yield key, unpack(key)[0]


def mine(keys: Iterator[bytes], most: int, percent: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from the sorted pairs of positives and negatives."""
    at, windows, last = None, [], None
    for key in keys:
        if key == last:
            continue
        last = key
        anchor, score, negative, row = unpack(key)
        if anchor != at:
            at, windows = anchor, []
        if not negative:
            windows.append([row, score, 0])
            continue
        windows = [w for w in windows if w[2] < most and 100 * score >= percent * w[1]]
        for w in windows:
            w[2] += 1
            yield anchor, w[0], w[2], row, w[1], score


def _streamed(pairs: DataFrame, step, schema: str) -> DataFrame:
    """``step`` over the keys of each partition, its results in batches of bounded size."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        kinds = [{"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}[part.split()[1]] for part in schema.split(", ")]
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], kind) for i, kind in enumerate(kinds)], names)

        for row in step(key for batch in batches for key in batch.column("key").to_pylist()):
            held.append(row)
            if len(held) == 10_000:
                yield out()
                held = []
        yield out()

    return pairs.mapInArrow(work, schema)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vector (whole numbers), as from ``whole_vectors``; ``is_anchor`` is a condition on them.
    """
    spark = rows.sparkSession
    ship_package(spark)
    rows = materialize(rows.select("vec_id", "label", "vector"), "vectors")
    each = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("a")).select("vec_id", "a.*")
    blocks = max(1, -(-each.count() // ANCHORS))
    anchors = materialize(each.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(2 * blocks - 1 if blocks > 1 else 1))), "anchors")  # blocks of about half the bound
    results = []
    for (block,) in sorted(anchors.select("block").distinct().collect()):  # one number per block
        own = anchors.where(F.col("block") == block).orderBy("vec_id").select("vec_id", "label", "vector").toArrow()  # ANCHORS rows or so
        ids, labels = (own.column(n).to_numpy() for n in ("vec_id", "label"))
        vectors = own.column("vector").combine_chunks()
        width = max([0, *pc.list_value_length(vectors).to_pylist()])
        held = (ids, labels, _matrix(vectors, width))
        first = spark.sparkContext.broadcast((*held, {}))
        found = _streamed(_sorted_pairs(_positive_pairs(rows, first, positives)), lambda keys: first_positives(keys, positives), _PAIR)
        found = materialize(found, "positives")
        windows: dict[int, list[int]] = {}
        for r in found.collect():  # ``positives`` rows per anchor of the block
            windows.setdefault(r["anchor_id"], []).append(unpack(bytes(r["key"]))[1])
        second = spark.sparkContext.broadcast((*held, windows))
        pairs = _sorted_pairs(found.unionByName(_negative_pairs(rows, second, negatives, percent)))
        results.append(materialize(_streamed(pairs, lambda keys: mine(keys, negatives, percent), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"), "hard-negatives"))
        first.destroy()
        second.destroy()
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
