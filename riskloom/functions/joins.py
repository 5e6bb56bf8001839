"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

MAX_LOCAL_ROWS = 20_000  # lookups the driver may hold
MAX_BROADCAST_ROWS = 500_000  # narrow dimension rows sent to every executor
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.005  # a key above this share of the rows is spread out
SALTS = 64
SKETCH_KEYS = 200  # as many keys can hold HOT_SHARE of the rows each
SKETCH_ITEMS = 10_000  # keys a sketch follows: it misses none above HOT_SHARE


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Count rows, and the bytes of their values as text; both are added up where the rows are."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n in df.columns), F.lit(0))
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys that may hold a large share of the rows (None among them), from one pass with a frequent-item sketch that partitions merge.

    The list only decides which keys are spread over several tasks; every row is joined whatever it says.
    """
    k = F.col(f"`{key}`")
    top = F.expr(f"approx_top_k(`{key}`, {SKETCH_KEYS}, {SKETCH_ITEMS})")
    n, nulls, found = df.agg(F.count("*"), F.count_if(k.isNull()), top).first()  # SKETCH_KEYS keys at most
    least = max(2.0, HOT_SHARE * n)
    return [r["item"] for r in found or [] if r["item"] is not None and r["count"] > least] + [None] * (nulls > least)


def row_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A number below ``salts`` by the contents of the row and its partition.

    Not a random number: a task that runs again must send its rows to the same place, in whatever order they come. The partition spreads copies of one row.
    """
    return F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in df.columns], F.spark_partition_id()), F.lit(salts)).cast("int")


def skew_safe_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
                   broadcast_rows: int = MAX_BROADCAST_ROWS, keys_of: DataFrame | None = None) -> DataFrame:
    """Join many rows with a table that is unique on its key.

    A right side measured small is broadcast, and the left side is read by the join alone. Otherwise one pass over the left key finds the hot keys; their rows get a
    salt and the few right rows they need are repeated per salt; all other keys join by plain shuffle, whose partitioning later group-bys reuse. If the left side is itself a join, name its scan as ``keys_of``:
    that pass then reads the scan and not the join.
    """
    lk, rk = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    if fits_broadcast(right, broadcast_rows):
        return left.join(F.broadcast(right), lk == rk, how)
    hot = hot_keys(left if keys_of is None else keys_of, left_key)
    if not hot:
        return left.join(right, lk == rk, how)
    named = [k for k in hot if k is not None]
    # null keys match nothing, so they may go anywhere: spread them too
    salted = left.withColumn("__salt", F.when(lk.isin(named) | lk.isNull(), row_salt(left)).otherwise(0))
    repeated = right.withColumn("__copy", F.explode(F.when(rk.isin(named), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.join(repeated, (lk == rk) & (F.col("__salt") == F.col("__copy")), how).drop("__salt", "__copy")


@dataclass(frozen=True)
class Lookup:
    """A table computed once, unique on the key it is joined by."""

    df: DataFrame = field(repr=False)
    small: bool

    def select(self, *cols: Column) -> "Lookup":
        return Lookup(self.df.select(*cols), self.small)

    def where(self, condition: Column) -> "Lookup":
        return Lookup(self.df.where(condition), self.small)

    def hinted(self) -> DataFrame:
        """The table with a broadcast hint if it is small."""
        return F.broadcast(self.df) if self.small else self.df

    def attach(self, left: DataFrame, on: Column, key: str) -> DataFrame:
        """Left join on ``on == key``; the key column of the lookup is dropped."""
        if self.small:
            return left.join(F.broadcast(self.df), on == F.col(key), "left").drop(key)
        tagged = left.withColumn("__on", on)
        return skew_safe_join(tagged, self.df, "__on", key, "left").drop("__on", key)


def freeze(df: DataFrame, name: str, max_rows: int = MAX_LOCAL_ROWS) -> Lookup:
    """Compute a lookup once and fix its contents.

    Up to ``max_rows`` rows become a local table (the count is the size check);
    a larger one is written to the shared folder. The plan runs once.
    """
    kept = df.persist()
    try:
        if kept.count() > max_rows:
            return Lookup(materialize(kept, name), False)
        return Lookup(df.sparkSession.createDataFrame(kept.toArrow(), schema=df.schema), True)
    finally:
        kept.unpersist()
