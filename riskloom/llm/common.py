"""What the operators share: reading rows safely, running totals over a global order, word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.session import materialize, ship_package

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 20  # texts are worked on in runs of about this size, so memory does not follow the Arrow batch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator needs, under fixed names, so that other columns cannot clash.

    A null text becomes empty.
    """
    ship_package(docs.sparkSession)
    extra = [c(name).alias(alias) for alias, name in more.items()]
    return docs.select(c(id_col).alias("doc_id"), F.coalesce(c(text_col).cast("string"), F.lit("")).alias("text"), *extra)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """Remainder of crc32 over the id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def parts_for(rows: int, each: int = 2_000, least: int = 1) -> int:
    """A number of parts that follows the rows."""
    return max(least, -(-rows // each))


def running_total(df: DataFrame, order: list[Column], values: list[str], parts: int, name: str) -> DataFrame:
    """Adds ``<value>_total``: the sum of all rows up to and with this one in the global order.

    Rows are range-partitioned and written with their range number, sums of the ranges give each range its offset, and a window
    runs inside each range only, so no task sees more than one range. ``order`` must tell all rows apart.
    """
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), name)
    sums = ranged.groupBy("__part").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sums.select("__part", *[F.coalesce(F.sum(f"__{v}").over(before), F.lit(0)).alias(f"__{v}") for v in values])
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(offsets), "__part")  # as many rows as ranges
    return joined.withColumns({f"{v}_total": F.col(f"__{v}") + F.sum(v).over(within) for v in values}).drop("__part", *[f"__{v}" for v in values])


def running_by_key(df: DataFrame, key: str, order: list[Column], values: list[str], parts: int, name: str, xor: bool = False) -> DataFrame:
    """Adds ``<value>_upto``: the sum (or exclusive or) over the key's rows up to and with this one; rows with equal order stand in any order.

    Rows are range-partitioned by key and order and written with their range number. A key that reaches over several ranges gets its totals
    of the ranges before: they come from the first and the last key of each range alone, so no task sees more than one range whatever a key holds.
    """
    total = F.bit_xor if xor else F.sum
    ranged = materialize(df.repartitionByRange(parts, c(key), *order).withColumn("__part", F.spark_partition_id()), name)
    ends = ranged.groupBy("__part").agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))  # one row per range
    at_ends = ranged.join(F.broadcast(ends), "__part").where((c(key) == F.col("__lo")) | (c(key) == F.col("__hi")))
    sums = at_ends.groupBy("__part", c(key).alias("__key")).agg(*[total(v).alias(f"__{v}") for v in values])  # two rows per range at most
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col("__part").alias("__p"), "__key", *[F.coalesce(total(f"__{v}").over(before), F.lit(0)).alias(f"__{v}") for v in values])
    within = Window.partitionBy("__part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(carried), (F.col("__part") == F.col("__p")) & (c(key) == F.col("__key")), "left")

    def upto(v: str) -> Column:
        inside, carry = total(v).over(within), F.coalesce(F.col(f"__{v}"), F.lit(0))
        return inside.bitwiseXOR(carry) if xor else inside + carry

    return joined.select(*[c(n) for n in df.columns], *[upto(v).alias(f"{v}_upto") for v in values])


# ---- words and their hashes in numpy -------------------------------------------------------------------------------------------------

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, name: str, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 2 * CHUNK_BYTES), base, dtype=np.uint64)
            steps[0] = 1
            known = _powers[name] = np.multiply.accumulate(steps)
    return known[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers (multiply and shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def spans(lengths: list[int], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``size`` bytes; a longer text stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield start, i
            start, total = i, 0
        total += n + 1
    if len(lengths) > start:
        yield start, len(lengths)


def text_runs(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of an Arrow column of texts as bytes, with their index range."""
    for start, stop in spans(pc.binary_length(texts).to_pylist(), size):
        yield start, stop, texts.slice(start, stop - start).cast(pa.binary()).to_pylist()


class Words:
    """The words of several texts: 64-bit hashes, place of each word's first and last byte, first word of each text.

    Words are runs of bytes outside ``breaks`` (a table of 256 flags; ASCII white space unless given).
    """

    def __init__(self, texts: list[bytes], lower: bool = True, breaks: np.ndarray | None = None):
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.translate(_LOWER)
        self.bytes = buf = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_ends = np.cumsum(lengths)
        gap = (_IS_SPACE if breaks is None else breaks)[buf]
        edges = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1)))
        self.starts, self.ends = edges[0::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(buf) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[buf] * _power(_BASE, "up", len(buf)), out=sums[1:])
            raw = (sums[self.ends] - sums[self.starts]) * _power(_INVERSE, "down", len(buf) + 1)[self.starts]
            self.hashes = mix64(raw + (self.ends - self.starts).astype(np.uint64))
        self.firsts = np.searchsorted(self.starts, np.concatenate([[0], self.text_ends]))  # text i has words firsts[i] .. firsts[i + 1]
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.firsts))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and the text each lies in; a text of fewer words (but one at least) gives one run of all."""
    h, owner = words.hashes, words.owner
    with np.errstate(over="ignore"):
        n = len(h) - k + 1
        if n > 0:
            acc = np.zeros(n, dtype=np.uint64)
            for i in range(k):
                acc = mix64(acc * np.uint64(_BASE) + h[i:i + n])
            inside = owner[:n] == owner[k - 1:]
            runs, of = acc[inside], owner[:n][inside]
        else:
            runs, of = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        few = np.flatnonzero((words.counts > 0) & (words.counts < k))
        if len(few):
            short = np.zeros(len(few), dtype=np.uint64)
            for j, t in enumerate(few):
                acc1 = np.uint64(words.counts[t])  # unlike any full run
                for i in range(words.firsts[t], words.firsts[t + 1]):
                    acc1 = mix64(np.array([acc1 * np.uint64(_BASE) + h[i]], dtype=np.uint64))[0]
                short[j] = acc1
            runs, of = np.concatenate([runs, short]), np.concatenate([of, few])
    return runs, of
