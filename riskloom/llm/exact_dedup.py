"""Exact duplicates with heavy hitters removed on the map side.

Texts are equal when they agree after removal of white space. Misra-Gries summaries of all partitions, merged, name the digests
that may hold a large share of the rows; these (at most ``counters + 1``) are counted exactly, and their winners are broadcast, so that
their rows need no shuffle. All other digests go through ordinary grouping, where no group is large.

Defined results: a null text is the empty text, all empty texts are copies of each other; of rows with equal texts the longest original stays, among those the smallest
doc_id, and of repeated rows with one doc_id one; a null doc_id comes after all others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.llm.common import SPACES, narrow
from riskloom.session import materialize

COUNTERS = 2_048


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without white space, lower-case hex."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, ""), 256)


def frequent_keys(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries: keys that may hold more than ``2 / (counters + 1)`` of the rows; never more than ``counters + 1`` keys.

    Each partition keeps ``counters`` counts, which run short by at most its rows / (counters + 1); so do their sums.
    """

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for batch in batches:
            for key, n in batch[column].value_counts().items():
                held[key] = held.get(key, 0) + n
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {key: n - cut for key, n in held.items() if n > cut}
        yield pd.DataFrame({"key": list(held), "n": list(held.values())}).astype({"key": "object", "n": "int64"})

    least = max(2, df.count() // (counters + 1))
    sums = df.select(column).mapInPandas(summarise, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= least).select(F.col("key").alias(column))


def _winners(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "__row"))
    return rows.groupBy("text_sha256").agg(F.count("*").alias("group_size"), best.alias("best")).select(
        "text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.__row").alias("__keep"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = narrow(docs, id_col, text_col).select(
        "doc_id", F.char_length("text").alias("n_chars"), text_digest(F.col("text")).alias("text_sha256"), F.monotonically_increasing_id().alias("__row"))
    rows = materialize(rows, "digests")
    frequent = frequent_keys(rows, "text_sha256", counters)
    heavy = materialize(_winners(rows.join(F.broadcast(frequent), "text_sha256", "left_semi")), "heavy-digests")  # counters + 1 rows at most
    from_heavy = rows.join(F.broadcast(heavy), "text_sha256")
    rest = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    both = from_heavy.unionByName(rest.join(_winners(rest), "text_sha256"))
    return both.select("doc_id", "keep_id", "group_size", (F.col("__row") == F.col("__keep")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; one row of each group of equal texts, also where ids repeat."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    tagged = docs.withColumn("__digest", text_digest(docs[text_col].cast("string")))
    same = (F.col("__digest") == F.col("__sha")) & docs[id_col].eqNullSafe(F.col("__id"))
    if not docs.groupBy(id_col).count().where("count > 1").limit(1).count():
        return tagged.join(kept, same, "left_semi").drop("__digest")
    # an id with several equal texts: the longest of them stays, one of those as long
    tagged = tagged.withColumn("__n", F.coalesce(F.char_length(c(text_col).cast("string")), F.lit(0)))
    stay = tagged.join(kept, same, "left_semi")
    longest = stay.groupBy("__digest").agg(F.max("__n").alias("__most")).withColumnRenamed("__digest", "__of")
    stay = stay.join(longest, (F.col("__digest") == F.col("__of")) & (F.col("__n") == F.col("__most")), "left_semi")
    return stay.dropDuplicates(["__digest"]).drop("__digest", "__n")
