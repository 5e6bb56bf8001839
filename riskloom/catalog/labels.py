"""RFM, cluster and label queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_EVENTS, TXN_ORDERS, query, rounded
from riskloom.functions.exprs import c
from riskloom.operators import rfm as R
from riskloom.operators.aggregate import customer_target
from riskloom.operators.normalize import population_moments, standardized
from riskloom.plans.labels import basic_features as earlier_features, proxy_label
from riskloom.session import scratch_path
from riskloom.sources.tables import write_labels
from riskloom.sources.transactions import txn_events, txn_orders

_DAY = 86400000000


def _rfm_sql(plus: int = 0) -> str:
    return f"""rfm AS (SELECT CustomerId, CAST(floor(((SELECT epoch_us(max(ts)) FROM txn) + {plus * _DAY} - epoch_us(max(ts))) / {_DAY}) AS BIGINT) AS Recency,
  count(ts) AS Frequency, round(sum(Amount) + 1e-9, 2) + 0.0 AS Monetary FROM txn GROUP BY CustomerId)"""


@query(f"WITH {TXN_ORDERS}, {_rfm_sql()} SELECT * FROM rfm")
def rfm_orders(spark, sf_dir):
    """Recency, frequency, monetary value of the orders table."""
    return rounded(R.rfm(txn_orders(spark, sf_dir)), 2)


@query(f"WITH {TXN_EVENTS}, {_rfm_sql(1)} SELECT * FROM rfm")
def rfm_snapshot_plus_day(spark, sf_dir):
    """The same with the snapshot one day after the last transaction."""
    return rounded(R.rfm(txn_events(spark, sf_dir), plus_days=1), 2)


@query(f"""WITH {TXN_ORDERS}, {_rfm_sql()}, s AS (SELECT avg(Recency) AS rm, stddev_pop(Recency) AS rs, avg(Frequency) AS fm, stddev_pop(Frequency) AS fs,
  avg(Monetary) AS mm, stddev_pop(Monetary) AS ms FROM rfm)
SELECT CustomerId, round((Recency - rm) / rs + 1e-9, 4) + 0.0 AS Recency, round((Frequency - fm) / fs + 1e-9, 4) + 0.0 AS Frequency,
  round((Monetary - mm) / ms + 1e-9, 4) + 0.0 AS Monetary FROM rfm, s""")
def rfm_standardized(spark, sf_dir):
    """RFM in population standard deviations."""
    table = R.rfm(txn_orders(spark, sf_dir))
    stats = population_moments(table, {n: c(n).cast("double") for n in R.RFM})
    return rounded(table.select("CustomerId", *[standardized(c(n).cast("double"), *stats[n]).alias(n) for n in R.RFM]))


def _segments(spark, sf_dir):
    """RFM with three fixed recency segments in place of clusters."""
    cluster = F.when(F.col("Recency") <= 60, 0).when(F.col("Recency") <= 240, 1).otherwise(2)
    return R.rfm(txn_orders(spark, sf_dir)).withColumn("cluster", cluster)


_SEGMENTS = f"""{TXN_ORDERS}, {_rfm_sql()}, seg AS (SELECT *, CAST(CASE WHEN Recency <= 60 THEN 0 WHEN Recency <= 240 THEN 1 ELSE 2 END AS BIGINT) AS cluster FROM rfm),
prof AS (SELECT cluster, count(*) AS customers, avg(Recency) AS r, avg(Frequency) AS f, avg(Monetary) AS m FROM seg GROUP BY cluster)"""


@query(f"""WITH {_SEGMENTS} SELECT cluster, customers, round(r + 1e-9, 4) + 0.0 AS Recency, round(f + 1e-9, 4) + 0.0 AS Frequency, round(m + 1e-9, 2) + 0.0 AS Monetary,
  round((rank() OVER (ORDER BY r) + rank() OVER (ORDER BY f DESC) + rank() OVER (ORDER BY m DESC)) + 1e-9, 4) + 0.0 AS risk_score FROM prof""")
def cluster_profile(spark, sf_dir):
    """Size, means and risk score of each segment."""
    return rounded(R.score_profile(R.cluster_profile(_segments(spark, sf_dir))), Monetary=2)


@query(f"""WITH {_SEGMENTS}
SELECT 'documented' AS rule, cluster, CAST(rank() OVER (ORDER BY r) + rank() OVER (ORDER BY f DESC) + rank() OVER (ORDER BY m DESC) AS DOUBLE) AS score FROM prof
UNION ALL SELECT 'as_written', cluster, CAST(rank() OVER (ORDER BY r DESC) + rank() OVER (ORDER BY f) + rank() OVER (ORDER BY m) AS DOUBLE) FROM prof
UNION ALL SELECT 'fm_dense', cluster, CAST(-dense_rank() OVER (ORDER BY f) - dense_rank() OVER (ORDER BY m) AS DOUBLE) FROM prof""")
def risk_rules(spark, sf_dir):
    """Risk score of each segment under the three ranking rules."""
    centers = [r.asDict() for r in R.cluster_profile(_segments(spark, sf_dir)).collect()]  # three segments
    rows = [(rule, k, float(v)) for rule in ("documented", "as_written", "fm_dense") for k, v in R.cluster_scores(centers, rule).items()]
    return rounded(spark.createDataFrame(rows, "rule string, cluster bigint, score double"))


@query(f"WITH {_SEGMENTS}, s AS (SELECT cluster, rank() OVER (ORDER BY r) + rank() OVER (ORDER BY f DESC) + rank() OVER (ORDER BY m DESC) AS score FROM prof),"
       " best AS (SELECT cluster FROM s ORDER BY score DESC, cluster LIMIT 1)"
       " SELECT CustomerId, CAST(cluster = (SELECT cluster FROM best) AS BIGINT) AS is_high_risk FROM seg")
def high_risk_flag(spark, sf_dir):
    """Customers of the riskiest segment."""
    table = _segments(spark, sf_dir)
    centers = [r.asDict() for r in R.cluster_profile(table).collect()]
    return rounded(R.flag_high_risk(table, R.risky_cluster(centers)).select("CustomerId", "is_high_risk"))


@query(f"""WITH {TXN_EVENTS}, {_rfm_sql()}, y AS (SELECT CustomerId, max(FraudResult) AS is_high_risk FROM txn WHERE FraudResult = 1 OR CustomerId % 2 = 0 GROUP BY 1)
SELECT CustomerId, Recency, Frequency, is_high_risk FROM rfm LEFT JOIN y USING (CustomerId)""")
def label_join(spark, sf_dir):
    """Labels joined on features; customers without a label keep null."""
    txn = txn_events(spark, sf_dir)
    labels = customer_target(txn.where((F.col("FraudResult") == 1) | (F.col("CustomerId") % 2 == 0))).withColumnRenamed("HasFraud", "is_high_risk")
    return rounded(R.label_features(R.rfm(txn).drop("Monetary"), labels))


@query(f"WITH {TXN_ORDERS}, y AS (SELECT CustomerId, max(FraudResult) AS HasFraud FROM txn GROUP BY 1) SELECT HasFraud, count(*) AS n, round(count(*) / (SELECT count(*) FROM y) + 1e-9, 6) + 0.0 AS share FROM y GROUP BY 1")
def label_distribution(spark, sf_dir):
    """Count and share per class."""
    return rounded(R.label_distribution(customer_target(txn_orders(spark, sf_dir)), "HasFraud"), 6)


@query(f"WITH {_SEGMENTS} SELECT CustomerId, CAST(cluster = 2 AS BIGINT) AS is_high_risk, CAST(cluster = 2 AS BIGINT) AS base_label, Recency, Frequency FROM seg")
def label_sink(spark, sf_dir):
    """Labels and the analytics base table written and read back."""
    table = _segments(spark, sf_dir)
    labels = R.flag_high_risk(table, 2)
    one, two = write_labels(labels, R.label_features(table.select("CustomerId", "Recency", "Frequency"), labels), scratch_path(spark, "labels"))
    base = spark.read.parquet(two).withColumnRenamed("is_high_risk", "base_label")
    return rounded(spark.read.parquet(one).join(base, "CustomerId"))


# k-means again, step by step: state is one row per start with its list of centres; a start that rests is no longer carried on
_D = "((x - m.x) * (x - m.x) + (y - m.y) * (y - m.y) + (z - m.z) * (z - m.z))"
_NEW = ", ".join("CASE WHEN n{0} > 0 THEN {{'x': sx{0} / n{0}, 'y': sy{0} / n{0}, 'z': sz{0} / n{0}}} ELSE c[{1}] END".format(j, j + 1) for j in range(3))
_SUMS = ", ".join(f"CAST(count(*) FILTER (j = {j + 1}) AS DOUBLE) AS n{j}, " + ", ".join(f"CAST(sum({v}) FILTER (j = {j + 1}) AS DOUBLE) AS s{v}{j}" for v in "xyz") for j in range(3))
_SHIFT = " + ".join(f"((c[{j}].{v} - e[{j}].{v}) / 1000000) * ((c[{j}].{v} - e[{j}].{v}) / 1000000)" for j in (1, 2, 3) for v in "xyz")
_CLUSTERS = f"""WITH RECURSIVE {TXN_ORDERS}, r0 AS (SELECT CustomerId, CAST(floor((max(epoch_us(max(ts))) OVER () - epoch_us(max(ts))) / {_DAY}) AS BIGINT) AS Recency, count(ts) AS Frequency, sum(Amount) AS Monetary FROM txn GROUP BY CustomerId),
st AS (SELECT avg(Recency) AS rm, stddev_pop(Recency) AS rs, avg(Frequency) AS fm, stddev_pop(Frequency) AS fs, avg(Monetary) AS mm, stddev_pop(Monetary) AS ms FROM r0),
pt AS (SELECT r0.*, CAST(round((Recency - rm) / rs * 1000000) AS BIGINT) AS x, CAST(round((Frequency - fm) / fs * 1000000) AS BIGINT) AS y, CAST(round((Monetary - mm) / ms * 1000000) AS BIGINT) AS z FROM r0, st),
h AS (SELECT s, x, y, z, min(md5((42 + s) || '|' || CustomerId)) AS h FROM pt, range(10) AS q(s) GROUP BY ALL),
f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY s ORDER BY h) <= 3),
it(i, s, c, moving) AS (
  SELECT 0, s, list({{'x': CAST(x AS DOUBLE), 'y': CAST(y AS DOUBLE), 'z': CAST(z AS DOUBLE)}} ORDER BY h), true FROM f GROUP BY s
  UNION ALL
  SELECT i, s, e, NOT ({_SHIFT} <= 0.0001) FROM (
    SELECT i + 1 AS i, s, c, [{_NEW}] AS e FROM (
      SELECT i, s, any_value(c) AS c, {_SUMS} FROM (
        SELECT i, s, c, x, y, z, list_position(d, list_min(d)) AS j FROM (
          SELECT it.i, it.s, it.c, pt.x, pt.y, pt.z, list_transform(it.c, lambda m: {_D}) AS d FROM it, pt WHERE it.moving AND it.i < 300)) GROUP BY i, s))),
fin AS (SELECT s, arg_max(c, i) AS c FROM it GROUP BY s),
best AS (SELECT c FROM (SELECT s, any_value(c) AS c, sum(CAST(list_min(list_transform(c, lambda m: {_D})) / 1000000 AS DECIMAL(28, 0))) AS cost FROM fin, pt GROUP BY s) ORDER BY cost, s LIMIT 1),
m0 AS (SELECT unnest(c) AS m FROM best),
ctr AS (SELECT m, m.x / 1000000 * rs + rm AS Recency, m.y / 1000000 * fs + fm AS Frequency, m.z / 1000000 * ms + mm AS Monetary FROM m0, st),
ord AS (SELECT *, row_number() OVER (ORDER BY Recency, Frequency, Monetary) - 1 AS cluster,
  CAST(rank() OVER (ORDER BY Recency) + rank() OVER (ORDER BY Frequency DESC) + rank() OVER (ORDER BY Monetary DESC) AS DOUBLE) AS risk_score FROM ctr),
risky AS (SELECT cluster FROM ord ORDER BY risk_score DESC, cluster LIMIT 1),
lst AS (SELECT list(m ORDER BY cluster) AS c FROM ord)"""


@query(f"""{_CLUSTERS}, lab AS (SELECT pt.*, list_position(d, list_min(d)) - 1 AS cluster FROM (SELECT pt.*, list_transform(lst.c, lambda m: {_D}) AS d FROM pt, lst) AS pt)
SELECT CustomerId, Recency, Frequency, round(Monetary + 1e-9, 2) + 0.0 AS Monetary, CAST(cluster AS BIGINT) AS cluster, CAST(cluster = (SELECT cluster FROM risky) AS BIGINT) AS is_high_risk FROM lab""")
def high_risk_label(spark, sf_dir):
    """RFM clusters by k-means and the proxy risk label."""
    return rounded(proxy_label(txn_orders(spark, sf_dir)).labels, Monetary=2)


@query(f"""{_CLUSTERS} SELECT round(Recency + 1e-9, 4) + 0.0 AS Recency, round(Frequency + 1e-9, 4) + 0.0 AS Frequency, round(Monetary + 1e-9, 2) + 0.0 AS Monetary, CAST(cluster AS BIGINT) AS cluster, risk_score FROM ord""")
def cluster_centers(spark, sf_dir):
    """k-means centres in original units with their risk score."""
    return rounded(proxy_label(txn_orders(spark, sf_dir)).centers(), Monetary=2)


_FM_DENSE = "fm AS (SELECT cluster FROM (SELECT cluster, -dense_rank() OVER (ORDER BY Frequency) - dense_rank() OVER (ORDER BY Monetary) AS score FROM ord) ORDER BY score DESC, cluster LIMIT 1)"


@query(f"""{_CLUSTERS}, {_FM_DENSE}, lab AS (SELECT pt.*, list_position(d, list_min(d)) - 1 AS cluster FROM (SELECT pt.*, list_transform(lst.c, lambda m: {_D}) AS d FROM pt, lst) AS pt)
SELECT CustomerId, round(Monetary + 1e-9, 2) + 0.0 AS Amount_sum, Frequency AS TransactionStartTime_count, CAST(cluster = (SELECT cluster FROM fm) AS BIGINT) AS is_high_risk,
  'RFM clustering (KMeans) on transaction history' AS label_transformation FROM lab""")
def basic_features(spark, sf_dir):
    """The earlier feature set with its own label: snapshot a day later, frequency and monetary rule."""
    features, dictionary = earlier_features(txn_orders(spark, sf_dir))
    described = dictionary.where("Feature = 'is_high_risk'").select(F.col("Transformation").alias("label_transformation"))  # one row
    out = features.select("CustomerId", "Amount_sum", "TransactionStartTime_count", "is_high_risk").withColumn("label_transformation", described.scalar())
    return rounded(out, Amount_sum=2)


@query("SELECT count(DISTINCT o_custkey) AS customers, CAST(3 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, CAST(1 AS BIGINT) AS risky_clusters, CAST(0 AS BIGINT) AS drifted FROM orders")
def kmeans_invariants(spark, sf_dir):
    """Every customer sits in the cluster with the nearest centre, centres are the means of their members, one cluster is risky."""
    result = proxy_label(txn_orders(spark, sf_dir))
    table, centers = result.labels, result.clusters.centers
    stats = population_moments(table, {n: c(n).cast("double") for n in R.RFM})
    distances = [sum(((c(n) - F.lit(float(k[n]))) / F.lit(stats[n][1])) ** 2 for n in R.RFM) for k in centers]
    own = F.element_at(F.array(*distances), F.col("cluster") + 1)
    means = {r["cluster"]: r for r in R.cluster_profile(table).collect()}  # three rows
    drifted = sum(any(abs(k[n] - means[k["cluster"]][n]) > 0.02 * stats[n][1] for n in R.RFM) for k in centers)
    return table.agg(F.lit(drifted).cast("bigint").alias("drifted"), F.count("*").alias("customers"), F.count_distinct("cluster").alias("clusters"),
                     F.count_if(own > F.least(*distances) + 1e-9).alias("misplaced"),
                     F.count_distinct(F.when(F.col("is_high_risk") == 1, F.col("cluster"))).alias("risky_clusters"))
