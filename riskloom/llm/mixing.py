"""Mixing sources to target weights by weighted fair queueing.

Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, ... Each document may be taken up to three times. In the shuffled order
of its source (three rounds, one after another) each copy has a virtual finish time: words of the source so far divided by the weight.
All copies are range-sorted by that time and taken until the budget, the words of all documents, is spent. A source that
runs dry leaves its share to the others by weight, which is what the targets say too. Times are whole numbers (words times 6 / weight).

Defined results: a null text has size 0, and size 0 takes nothing; null is a source of its own; repeated rows count as rows; an empty
table gives an empty result; other columns are ignored. The shuffle is the md5 of the doc_id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.llm.common import narrow, parts_for, running_total, word_count
from riskloom.session import materialize

ROUNDS = 3
WEIGHTS = 3  # weights 1, 2, 3, repeating
TIME_UNIT = 6  # divisible by every weight
ROWS_PER_RANGE = 20_000  # of the sorted orders; the driver samples each range's bounds


def _targets(sized: DataFrame, budget: int) -> DataFrame:
    """Per source: weight, size, words before it in source order, and target (weights shared out again past three times a size)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("size")).withColumn("one", F.lit(1))
    by_name = [F.col("source").isNull(), F.col("source")]
    n = sources.count()
    ranked = running_total(sources, by_name, ["one", "size"], parts_for(n, 50_000), "mix-sources").select(
        "source", "size", (F.col("size_total") - F.col("size")).alias("before"), F.col("one_total").alias("rank"),
        (F.pmod(F.col("one_total") - 1, F.lit(WEIGHTS)) + 1).alias("weight"))
    ranked = ranked.withColumn("cap", ROUNDS * F.col("size")).withColumn("level", F.col("cap") * (TIME_UNIT / F.col("weight")).cast("bigint"))
    filled = running_total(ranked, [F.col("level"), F.col("rank")], ["cap", "weight"], parts_for(n, 50_000), "mix-levels")
    weights = n // WEIGHTS * 6 + (0, 1, 3)[n % WEIGHTS]  # 1 + 2 + 3 for each whole run of sources, and what is left
    # full at this level: what is left for it and all above would lift them past it
    rest = budget - (F.col("cap_total") - F.col("cap"))
    full = rest * TIME_UNIT > F.col("level") * (weights - (F.col("weight_total") - F.col("weight")))
    filled = materialize(filled.withColumn("full", full), "mix-targets")
    spent, open_weight = filled.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0))).first()
    share = F.lit(budget - spent).cast("double") * F.col("weight") / F.lit(max(open_weight, 1)).cast("double")
    return filled.select(F.col("source").alias("__source"), F.col("size").alias("source_size"), "before", "rank", "weight",
                         F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, source."""
    sized = narrow(docs, id_col, text_col, source=source_col).select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("row"))
    sized = materialize(sized, "mix-sizes")
    n, budget = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = parts_for(n, ROWS_PER_RANGE)
    placed = running_total(sized, [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("row")], ["size"], parts, "mix-order")
    targets = _targets(sized, budget)
    queued = placed.join(targets, placed["source"].eqNullSafe(targets["__source"])).drop("__source")
    # finish times of the rounds of a document, in order
    step = (TIME_UNIT / F.col("weight")).cast("bigint")
    queued = materialize(queued.withColumn("first", F.col("size_total") - F.col("before")).withColumn(
        "times", F.array(*[(F.col("first") + i * F.col("source_size")) * step for i in range(ROUNDS)])).drop("size_total", "before", "first", "weight"), "mix-queue")
    copies = queued.where("size > 0").select("size", "rank", "key", "row", F.posexplode("times").alias("round", "time"))
    order = ["time", "rank", "key", "row"]
    summed = running_total(copies, [F.col(x) for x in order], ["size"], parts_for(ROUNDS * n, ROWS_PER_RANGE), "mix-copies")
    last = summed.where(F.col("size_total") <= budget).agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        taken = F.lit(0)
    else:
        end = F.struct(*[F.lit(last[x]).cast(queued.schema[x].dataType if x != "time" else "bigint").alias(x) for x in order])
        taken = F.size(F.filter("times", lambda t: F.struct(t.alias("time"), *[F.col(x) for x in order[1:]]) <= end))
    return queued.select("doc_id", "size", "source_size", "target", (F.col("size") * taken).cast("bigint").alias("taken"), "source")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it was taken."""
    mix = mix_sources(docs, id_col, text_col, source_col).where("taken > 0").select(F.col("doc_id").alias("__id"), (F.col("taken") / F.col("size")).cast("int").alias("__times"))
    mix = mix.groupBy("__id").agg(F.max("__times").alias("__times"))
    joined = docs.where(word_count(c(text_col)) > 0).join(mix, docs[id_col].eqNullSafe(F.col("__id")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*[c(n) for n in docs.columns])
