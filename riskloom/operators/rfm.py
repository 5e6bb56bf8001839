"""Recency, frequency, monetary value, their clusters, and the proxy risk label."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.functions.exprs import c, day_floor, elapsed_micros, nan_to_null
from riskloom.operators import kmeans
from riskloom.operators.aggregate import with_customer
from riskloom.operators.normalize import population_moments, standardized
from riskloom.session import materialize

RFM = ("Recency", "Frequency", "Monetary")


def rfm(txn: DataFrame, cols: TxnColumns = DEFAULT, snapshot: Column | None = None, plus_days: int = 0) -> DataFrame:
    """Whole days since the last transaction, number of transactions and their sum.

    ``snapshot`` defaults to the latest time in the table plus ``plus_days``.
    """
    txn = nan_to_null(txn, [cols.amount])
    if snapshot is None:
        latest = F.max(c(cols.time))
        if plus_days:
            latest = latest + F.expr(f"INTERVAL '{int(plus_days)}' DAY")
        snapshot = txn.agg(latest.alias("snapshot")).scalar()
    grouped = with_customer(txn, cols).groupBy(c(cols.id)).agg(
        F.max(c(cols.time)).alias("__last"),
        F.count(c(cols.time)).alias("Frequency"),
        F.coalesce(F.sum(c(cols.amount)), F.lit(0)).cast("double").alias("Monetary"))
    return grouped.select(c(cols.id), day_floor(elapsed_micros(snapshot, F.col("__last"))).alias("Recency"), "Frequency", "Monetary")


@dataclass
class RfmClusters:
    """Clustered RFM table and its centres in original units."""

    labeled: DataFrame = field(repr=False)
    centers: list[dict]
    cost: float

    def centers_frame(self, rule: str = "documented") -> DataFrame:
        spark = self.labeled.sparkSession
        scores = cluster_scores(self.centers, rule)
        rows = [(*[float(r[n]) for n in RFM], r["cluster"], float(scores[r["cluster"]])) for r in self.centers]
        return spark.createDataFrame(rows, "Recency double, Frequency double, Monetary double, cluster int, risk_score double")


def cluster_rfm(table: DataFrame, k: int = 3, seed: int = 42, starts: int = 10, scale: bool = True, id_col: str = "CustomerId") -> RfmClusters:
    """k-means on standardised RFM; the cheapest of several starts wins, and all starts advance in the same aggregates.

    Clusters are numbered by their centre (most recent first), not by chance of the start. Customers with a missing value are left out.
    ``table`` is read many times: pass a materialised one.
    """
    n = table.count()
    if n < k:
        raise ValueError(f"{k} clusters need at least {k} customers, got {n}")
    stats = population_moments(table, {f: c(f).cast("double") for f in RFM}) if scale else {f: (0.0, 1.0) for f in RFM}
    grid = {f"__z{f}": kmeans.grid_point(standardized(c(f).cast("double"), *stats[f])) for f in RFM}
    points = table.dropna(subset=list(RFM)).withColumns(grid)
    narrow = points.select(c(id_col), *grid)
    if n <= kmeans.SPREAD_ROWS:  # few rows may come in one partition: every iteration would be one task
        narrow = narrow.repartition(table.sparkSession.sparkContext.defaultParallelism, c(id_col))
    narrow = materialize(narrow, "rfm-points")
    found = kmeans.fit(narrow, list(grid), id_col, k, seed, starts)
    raw = [[z / kmeans.GRID * (stats[f][1] or 1.0) + stats[f][0] for f, z in zip(RFM, center)] for center in found.centers]
    order = sorted(range(len(raw)), key=lambda i: raw[i])
    labeled = points.withColumn("cluster", kmeans.nearest([c(n) for n in grid], [found.centers[old] for old in order])).select(*[c(n) for n in table.columns], "cluster")
    centers = [dict(zip(RFM, raw[old]), cluster=new) for new, old in enumerate(order)]
    return RfmClusters(labeled, centers, found.cost)


def _average_ranks(values: list[float], ascending: bool) -> list[float]:
    ordered = sorted(values, reverse=not ascending)
    return [(ordered.index(v) + 1 + len(ordered) - ordered[::-1].index(v)) / 2 for v in values]


def cluster_scores(centers: list[dict], rule: str = "documented") -> dict[int, float]:
    """Risk score per cluster, highest = riskiest (k rows, driver side by construction).

    ``documented``: inactive, rare and small buyers score high.
    ``as_written``: the inverted ranks some published results rest on.
    ``fm_dense``: dense ranks of frequency and monetary value, lowest sum = riskiest.
    """
    by = {f: [r[f] for r in centers] for f in RFM}
    if rule == "documented":
        ranks = [_average_ranks(by["Recency"], True), _average_ranks(by["Frequency"], False), _average_ranks(by["Monetary"], False)]
    elif rule == "as_written":
        ranks = [_average_ranks(by["Recency"], False), _average_ranks(by["Frequency"], True), _average_ranks(by["Monetary"], True)]
    elif rule == "fm_dense":
        dense = [[float(-sorted(set(v)).index(x) - 1) for x in v] for v in (by["Frequency"], by["Monetary"])]
        ranks = dense
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return {r["cluster"]: sum(col[i] for col in ranks) for i, r in enumerate(centers)}


def risky_cluster(centers: list[dict], rule: str = "documented") -> int:
    """Cluster with the highest score; the lowest number on ties."""
    scores = cluster_scores(centers, rule)
    return min(scores, key=lambda k: (-scores[k], k))


def cluster_profile(labeled: DataFrame) -> DataFrame:
    """Means and sizes per cluster."""
    return labeled.groupBy("cluster").agg(F.count("*").alias("customers"), *[F.avg(f).alias(f) for f in RFM])


def score_profile(profile: DataFrame) -> DataFrame:
    """The documented rule on a profile table of k rows, as a plan."""
    k = Window.partitionBy(F.lit(1))

    def rank(name: str, ascending: bool) -> Column:
        order = c(name) if ascending else c(name).desc()
        first = F.rank().over(k.orderBy(order))
        ties = F.count("*").over(Window.partitionBy(c(name)))
        return first + (ties - 1) / 2

    return profile.withColumn("risk_score", rank("Recency", True) + rank("Frequency", False) + rank("Monetary", False))


def flag_high_risk(labeled: DataFrame, cluster: int) -> DataFrame:
    return labeled.withColumn("is_high_risk", (F.col("cluster") == F.lit(cluster)).cast("int"))


def label_features(features: DataFrame, labels: DataFrame, id_col: str = "CustomerId") -> DataFrame:
    """Features with the proxy label; customers without a label keep null."""
    return features.join(labels.select(c(id_col), "is_high_risk"), id_col, "left")


def label_distribution(df: DataFrame, label: str = "is_high_risk") -> DataFrame:
    """Count and share per class."""
    counts = df.where(c(label).isNotNull()).groupBy(c(label)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row per class
    return counts.withColumn("share", F.col("n") / total)
