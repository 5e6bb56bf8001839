"""Frozen text-to-number maps of many features as one expression, without a join per feature.

All maps share one hash table: an array of buckets, each a small map of the few entries (feature and key to value) whose hash falls there. The table is one row that Spark makes and that
goes into plans as a scalar; a lookup is a hash, an array access and a look at one bucket, however many features and keys there are. Features with few keys
become conditions instead, which need no table at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.joins import Lookup, fits_broadcast, skew_safe_join

FEW_KEYS = 24  # keys of a feature up to which it becomes conditions
PACKED_ROWS = 200_000
PACKED_BYTES = 16 * 1024 * 1024


def _bucket(feature: Column, key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(feature, key), F.lit(buckets)).cast("int")


def _entry(feature: Column, key: Column) -> Column:
    return F.concat_ws("\x1f", feature, key)


class PackedMaps:
    """Lookups of ``value`` by (feature, key) over a frozen table that is unique on both.

    Features whose keys are too many for the table (measured) are left to a join; ``attach`` does whatever is needed.
    """

    def __init__(self, lookup: Lookup, feature: str, key: str, value: str):
        self.rows = lookup.select(F.col(feature).alias("__f"), F.col(key).alias("__k"), F.col(value).cast("double").alias("__x"))
        sizes = {r["__f"]: r["n"] for r in self.rows.df.groupBy("__f").agg(F.count("*").alias("n")).collect()}  # one row per feature
        few = [f for f, n in sizes.items() if n <= FEW_KEYS]
        self.conditions: dict[str, list[tuple]] = {f: [] for f in few}
        for r in self.rows.df.where(F.col("__f").isin(few)).collect() if few else []:  # FEW_KEYS rows per feature
            self.conditions[r["__f"]].append((r["__k"], r["__x"]))
        # the smallest first, as many as the table may hold
        left, packed = PACKED_ROWS, []
        for f, n in sorted(sizes.items(), key=lambda kv: (kv[1], kv[0])):
            if n > FEW_KEYS and n <= left:
                packed.append(f)
                left -= n
        if packed and not fits_broadcast(self.rows.df.where(F.col("__f").isin(packed)), PACKED_ROWS, PACKED_BYTES):
            packed = []
        self.packed = set(packed)
        self.joined = [f for f, n in sizes.items() if n > FEW_KEYS and f not in self.packed]
        self.buckets = max(1, sum(sizes[f] for f in packed))
        self.table = self._table() if packed else None

    def _table(self) -> Column:
        inside = self.rows.df.where(F.col("__f").isin(list(self.packed)))
        entries = F.collect_list(F.struct(_entry(F.col("__f"), F.col("__k")).alias("k"), F.col("__x").alias("x")))  # a few
        filled = inside.groupBy(_bucket(F.col("__f"), F.col("__k"), self.buckets).alias("b")).agg(entries.alias("e"))
        spark = inside.sparkSession
        every = spark.range(self.buckets).withColumn("b", F.col("id").cast("int")).join(filled, "b", "left")
        row = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "e"))), lambda s: F.map_from_entries(s["e"])).alias("t"))  # PACKED_ROWS buckets at most
        return spark.createDataFrame(row.toArrow(), schema=row.schema).select("t").scalar()

    def value(self, feature: str, key: Column) -> Column:
        """The feature's value at ``key`` (text); null where there is none. Not for features in ``joined``."""
        if feature in self.packed:
            return F.try_element_at(F.get(self.table, _bucket(F.lit(feature), key, self.buckets)), _entry(F.lit(feature), key))
        out = F.lit(None).cast("double")
        for k, x in self.conditions.get(feature, []):
            out = F.when(key == F.lit(k), F.lit(x)).otherwise(out)
        return out

    def attach(self, df: DataFrame, keys: dict[str, Column], names: dict[str, str], missing: float = 0.0) -> DataFrame:
        """``df`` with a column ``names[feature]`` for every feature: the value at ``keys[feature]``, or ``missing``."""
        out = df
        for f in (f for f in keys if f in self.joined):
            mine = self.rows.df.where(F.col("__f") == f).select(F.col("__k").alias(f"__k_{f}"), F.col("__x").alias(names[f]))
            out = skew_safe_join(out.withColumn(f"__on_{f}", keys[f]), mine, f"__on_{f}", f"__k_{f}", "left").drop(f"__on_{f}", f"__k_{f}")
        values = {names[f]: F.coalesce(F.col(f"`{names[f]}`") if f in self.joined else self.value(f, k), F.lit(missing)) for f, k in keys.items()}
        return out.withColumns(values) if values else out
