"""Proxy label plan: RFM, clusters, risky cluster, label, join with features."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.operators.rfm import RfmClusters, cluster_rfm, flag_high_risk, label_distribution, label_features, rfm, risky_cluster
from riskloom.plans.dictionary import feature_dictionary
from riskloom.plans.features import BASIC, FeatureConfig, build_features
from riskloom.session import materialize


@dataclass
class ProxyLabel:
    labels: DataFrame = field(repr=False)
    features_with_label: DataFrame | None = field(repr=False)
    clusters: RfmClusters = field(repr=False)
    rule: str

    def centers(self) -> DataFrame:
        return self.clusters.centers_frame(self.rule)

    def distribution(self) -> DataFrame:
        return label_distribution(self.labels)


def proxy_label(
    txn: DataFrame,
    features: DataFrame | None = None,
    cols: TxnColumns = DEFAULT,
    snapshot: Column | None = None,
    plus_days: int = 0,
    rule: str = "documented",
    k: int = 3,
    seed: int = 42,
    scale: bool = True,
) -> ProxyLabel:
    """Label customers of the riskiest RFM cluster; one row per customer is kept for k-means."""
    table = materialize(rfm(txn, cols, snapshot, plus_days), "rfm")
    clusters = cluster_rfm(table, k, seed, scale=scale, id_col=cols.id)
    labels = flag_high_risk(clusters.labeled, risky_cluster(clusters.centers, rule))
    joined = label_features(features, labels, cols.id) if features is not None else None
    return ProxyLabel(labels, joined, clusters, rule)


def basic_features(txn: DataFrame, cfg: FeatureConfig = BASIC) -> tuple[DataFrame, DataFrame]:
    """The earlier feature set with its own label: snapshot one day after the last transaction, frequency / monetary rule."""
    features, dictionary = build_features(txn, cfg)
    labeled = proxy_label(txn, features, cfg.cols, plus_days=1, rule="fm_dense").features_with_label
    row = feature_dictionary(txn.sparkSession, [("is_high_risk", "label")], {})
    return labeled, dictionary.unionByName(row)
