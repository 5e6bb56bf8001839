"""Classification metrics, threshold curves and the dataset fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.functions.order_stats import grouped_running_totals, running_totals


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(c(label).alias("label"), c(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 from one aggregate; 0 where undefined."""
    y, p = c(label).cast("int"), c(prediction).cast("int")
    cells = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return cells.select(ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
                        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``score, pos, neg``: one row per distinct score."""
    y = c(label).cast("int")
    return (df.where(c(score).isNotNull() & y.isNotNull()).groupBy(c(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def threshold_table(df: DataFrame, label: str = "label", score: str = "score", rows_per_split: int = 200_000) -> DataFrame:
    """``score, pos, neg, tp, fp``: rows predicted positive at ``>= score``."""
    return running_totals(score_counts(df, label, score), "score", {"tp": "pos", "fp": "neg"},
                          ascending=False, rows_per_split=rows_per_split)


def _with_class_totals(table: DataFrame) -> DataFrame:
    totals = table.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return table.withColumns({"p": totals.select("p").scalar(), "n": totals.select("n").scalar()})


def roc_points(df: DataFrame, label: str = "label", score: str = "score", rows_per_split: int = 200_000) -> DataFrame:
    """``threshold, fpr, tpr`` at every distinct score, with the (0, 0) start at threshold infinity."""
    table = _with_class_totals(threshold_table(df, label, score, rows_per_split))
    points = table.select(F.col("score").alias("threshold"), F.try_divide(F.col("fp"), F.col("n")).alias("fpr"),
                          F.try_divide(F.col("tp"), F.col("p")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def pr_points(df: DataFrame, label: str = "label", score: str = "score", rows_per_split: int = 200_000) -> DataFrame:
    """``threshold, precision, recall`` at every distinct score, with the (1, 0) end at threshold infinity."""
    table = _with_class_totals(threshold_table(df, label, score, rows_per_split))
    points = table.select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                          F.try_divide(F.col("tp"), F.col("p")).alias("recall"))
    end = df.sparkSession.createDataFrame([(float("inf"), 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", rows_per_split: int = 200_000) -> DataFrame:
    """Exact area under the ROC curve: pairs won plus half of the ties; null with one class."""
    table = threshold_table(df, label, score, rows_per_split)
    won = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return table.agg(F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def grouped_auc(df: DataFrame, groups: list[str], label: str = "label", score: str = "score", rows_per_split: int = 200_000) -> DataFrame:
    """``groups..., roc_auc``: the exact area of every group, in one pass over all groups."""
    y = c(label).cast("int")
    counts = (df.where(c(score).isNotNull() & y.isNotNull()).groupBy(*[c(g) for g in groups], c(score).cast("double").alias("score"))
              .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))
    table = grouped_running_totals(counts, groups, "score", {"tp": "pos"}, ascending=False, rows_per_split=rows_per_split)
    won = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return table.groupBy(*[c(g) for g in groups]).agg(F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """The five metrics in one row."""
    auc = roc_auc(df, label, score).select("roc_auc").scalar()
    return class_metrics(df, label, prediction).withColumn("roc_auc", auc)


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-free dataset hash: md5 over the row count and the sum of row hashes.

    60 bits of each row's md5 are summed as decimals, so copies count and the
    order of rows and files does not. Executors add up their own rows.
    """
    cols = cols or df.columns
    parts = [F.coalesce(c(n).cast("string"), F.lit("\\N")) for n in cols]
    row = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("decimal(28,0)")
    sums = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("decimal(38,0)").alias("total"))
    text = F.concat_ws(":", F.col("rows").cast("string"), F.col("total").cast("string"))
    return sums.select("rows", F.md5(text).alias("data_hash"))
