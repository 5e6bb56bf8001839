"""Reproducible train / test splits and folds with exact sizes.

Rows are ordered by the md5 of seed and key. The n-th smallest hash of a stratum is found by radix selection: counts per next
hash digits say which prefix holds it, as often as it takes for that prefix to hold few rows; their number is chosen by the measured size. The
split itself is a filter against one threshold per stratum, so no stratum is sorted, however large it is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.exprs import c, row_hash
from riskloom.functions.joins import Lookup, freeze

PIVOT_ROWS = 10_000  # rows of one prefix that a window may order
MAX_DIGITS = 4  # per round: 65,536 counts per prefix at most
_HASH_DIGITS = 32
_H, _S = "__hash", "__stratum"


def _in_pivots(keyed: DataFrame, pivots: Lookup) -> DataFrame:
    """Rows of ``keyed`` next to each prefix (s, prefix, ...) they lie in."""
    same = keyed[_S].eqNullSafe(F.col("s")) & F.col(_H).startswith(F.col("prefix"))
    return keyed.join(pivots.hinted(), same)


def _cut_points(keyed: DataFrame, wanted: list[Column], pivot_rows: int = PIVOT_ROWS) -> DataFrame:
    """``s, cut, threshold``: hash of the wanted-th row of each stratum (``wanted`` may use ``total``)."""
    wants = F.array(*[F.struct(F.lit(i).alias("cut"), w.cast("bigint").alias("need")) for i, w in enumerate(wanted, 1)])
    totals = keyed.groupBy(F.col(_S).alias("s")).agg(F.count("*").alias("total"))
    cuts = totals.select("s", F.col("total").alias("size"), F.lit("").alias("prefix"), F.inline(wants)).where((F.col("need") >= 1) & (F.col("need") <= F.col("size")))
    done, pivots, out = [], freeze(cuts, "split-cuts-wanted"), None
    while True:
        whole = F.length("prefix") >= _HASH_DIGITS  # copies of one key
        large = pivots.where((F.col("size") > pivot_rows) & ~whole)
        largest = large.df.agg(F.max("size")).first()[0]
        done.append(pivots.where((F.col("size") <= pivot_rows) & ~whole))
        copies = pivots.df.where(whole).select("s", "cut", F.col("prefix").alias("threshold"))
        out = copies if out is None else out.unionByName(copies)
        if largest is None:
            break
        digits = min(MAX_DIGITS, math.ceil(math.log(largest / pivot_rows, 16)) or 1)
        prefixes = Lookup(large.df.select("s", "prefix").distinct(), large.small)
        child = F.substring(F.col(_H), F.length("prefix") + 1, F.lit(digits)).alias("child")
        counts = _in_pivots(keyed, prefixes).groupBy("s", "prefix", child).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("s", "prefix").orderBy("child").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counted = counts.withColumn("upto", upto).withColumnsRenamed({"s": "__s", "prefix": "__p"})
        inside = counted.join(large.hinted(), F.col("__s").eqNullSafe(F.col("s")) & (F.col("__p") == F.col("prefix")))
        inside = inside.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        pivots = freeze(inside.select("s", F.col("n").alias("size"), F.concat("prefix", "child").alias("prefix"), "cut", (F.col("need") - F.col("upto") + F.col("n")).alias("need")), "split-pivots")
    for small in done:  # one per round
        rows = _in_pivots(keyed, small)
        position = F.row_number().over(Window.partitionBy("s", "cut").orderBy(_H))
        found = rows.select("s", "cut", _H, "need").withColumn("r", position).where(F.col("r") == F.col("need")).select("s", "cut", F.col(_H).alias("threshold"))
        out = out.unionByName(found)
    return out


def _keyed(df: DataFrame, keys: list[str], seed: int, stratum: Column) -> DataFrame:
    return df.select(row_hash(seed, keys).alias(_H), stratum.alias(_S))


def stratified_split(df: DataFrame, stratum: str, keys: list[str], test_frac: float = 0.2, seed: int = 42,
                     at_least_one: bool = True, pivot_rows: int = PIVOT_ROWS) -> DataFrame:
    """Add ``split`` = train / test with ``int(n * test_frac)`` test rows per stratum (at least 1).

    ``keys`` must identify a row. Rows with a null stratum belong to neither part.
    """
    df = df.where(c(stratum).isNotNull())
    size = F.floor(F.col("total") * F.lit(test_frac))
    want = F.greatest(F.lit(1), size) if at_least_one else size
    cuts = _cut_points(_keyed(df, keys, seed, c(stratum)), [want], pivot_rows).drop("cut")
    joined = freeze(cuts.withColumnsRenamed({"s": "__s", "threshold": "__t"}), "split-cuts").attach(df, c(stratum), "__s")
    is_test = F.col("__t").isNotNull() & (row_hash(seed, keys) <= F.col("__t"))
    return joined.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("__t")


def random_split(df: DataFrame, keys: list[str], test_frac: float = 0.2, seed: int = 42, pivot_rows: int = PIVOT_ROWS) -> DataFrame:
    """Add ``split`` with exactly ``round(n * test_frac)`` test rows (half to even)."""
    size = F.bround(F.col("total") * F.lit(test_frac), 0)
    threshold = _cut_points(_keyed(df, keys, seed, F.lit(0)), [size], pivot_rows).select("threshold").scalar()
    is_test = F.coalesce(row_hash(seed, keys) <= threshold, F.lit(False))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def model_split(df: DataFrame, label: str, keys: list[str], test_frac: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test tables with the label's class shares preserved."""
    both = stratified_split(df, label, keys, test_frac, seed)
    return (both.where(F.col("split") == "train").drop("split"), both.where(F.col("split") == "test").drop("split"))


def stratified_folds(df: DataFrame, label: str, keys: list[str], folds: int = 5, seed: int = 42, out: str = "fold",
                     pivot_rows: int = PIVOT_ROWS) -> DataFrame:
    """Fold number with equal class counts per fold (sizes differ by at most one)."""
    df = df.where(c(label).isNotNull())
    wanted = [F.floor(F.col("total") * F.lit(i) / F.lit(folds)) for i in range(1, folds)]
    cuts = _cut_points(_keyed(df, keys, seed, c(label)), wanted, pivot_rows)
    per_class = freeze(cuts.groupBy(F.col("s").alias("__s")).agg(F.array_sort(F.collect_list("threshold")).alias("__cuts")), "fold-cuts")  # folds - 1 each
    tagged = per_class.attach(df, c(label), "__s").withColumn("__h", row_hash(seed, keys))
    passed = F.filter("__cuts", lambda t: t < F.col("__h"))
    # classes smaller than the fold count have fewer cuts
    skipped = F.lit(folds - 1) - F.size("__cuts")
    return tagged.withColumn(out, F.coalesce(F.size(passed) + skipped, F.lit(folds - 1)).cast("int")).drop("__h", "__cuts")
