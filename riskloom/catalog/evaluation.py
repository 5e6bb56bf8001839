"""Training and evaluation queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_ORDERS, query, rounded
from riskloom.functions.exprs import c
from riskloom.operators import metrics as M
from riskloom.operators.aggregate import customer_aggregates, modal_categories
from riskloom.operators.rfm import rfm
from riskloom.operators.split import model_split as split_by_label
from riskloom.plans import training as T
from riskloom.session import materialize, scratch_path
from riskloom.sources.runlog import append_run_log, commits, read_run_log, stage_rows
from riskloom.sources.tables import read_table
from riskloom.sources.transactions import txn_orders

WEIGHTS = {"Frequency": 0.3, "Amount_mean": 0.00002}
INTERCEPT = -8.0

CUSTOMERS = f"""{TXN_ORDERS}, cust AS (SELECT CustomerId, count(ts) AS Frequency, avg(Amount) AS Amount_mean, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId)"""
SCORED = f"""{CUSTOMERS}, sc AS (SELECT CustomerId, HasFraud AS label, round(1 / (1 + exp(-(-8.0 + 0.3 * Frequency + 0.00002 * Amount_mean))) + 1e-9, 3) AS score,
  1 / (1 + exp(-(-8.0 + 0.3 * Frequency + 0.00002 * Amount_mean))) AS p FROM cust), pr AS (SELECT *, CAST(score >= 0.5 AS BIGINT) AS prediction FROM sc)"""


def customers(spark, sf_dir):
    """Frequency, mean amount and label per customer."""
    table = customer_aggregates(txn_orders(spark, sf_dir), recent=False, calendar=False)
    return table.select("CustomerId", F.col("TransactionStartTime_count").alias("Frequency"), "Amount_mean", "HasFraud")


def scored(spark, sf_dir):
    """Label, a closed-form score with ties, and its class."""
    z = INTERCEPT + sum(c(n) * w for n, w in WEIGHTS.items())
    score = F.round(1 / (1 + F.exp(-z)) + 1e-9, 3)
    return customers(spark, sf_dir).select("CustomerId", F.col("HasFraud").alias("label"), score.alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))


@query(f"WITH {SCORED} SELECT label, prediction, count(*) AS n FROM pr GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    """Counts per label and prediction."""
    return rounded(M.confusion_matrix(scored(spark, sf_dir)))


@query(f"""WITH {SCORED}, k AS (SELECT count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp, count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS fp,
  count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS fn, count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) AS tn FROM pr)
SELECT round((tp + tn) / (tp + tn + fp + fn) + 1e-9, 6) + 0.0 AS accuracy, round(tp / (tp + fp) + 1e-9, 6) + 0.0 AS "precision",
  round(tp / (tp + fn) + 1e-9, 6) + 0.0 AS recall, round(2 * tp / (2 * tp + fp + fn) + 1e-9, 6) + 0.0 AS f1 FROM k""")
def class_metrics(spark, sf_dir):
    """accuracy, precision, recall and f1."""
    return rounded(M.class_metrics(scored(spark, sf_dir)), 6)


_CUM = f"""{SCORED}, g AS (SELECT score, count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label = 0 THEN 1 END) AS neg FROM pr GROUP BY score),
u AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)"""


def _finite(df):
    return df.withColumn("threshold", F.when(F.col("threshold") < F.lit(float("inf")), F.col("threshold")))


@query(f"""WITH {_CUM} SELECT round(score + 1e-9, 6) + 0.0 AS threshold, round(fp / n + 1e-9, 6) + 0.0 AS fpr, round(tp / p + 1e-9, 6) + 0.0 AS tpr FROM u
UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_points(spark, sf_dir):
    """False and true positive rate at every score."""
    return rounded(_finite(M.roc_points(scored(spark, sf_dir), rows_per_split=100)), 6)


@query(f"""WITH {_CUM} SELECT round(score + 1e-9, 6) + 0.0 AS threshold, round(tp / (tp + fp) + 1e-9, 6) + 0.0 AS "precision", round(tp / p + 1e-9, 6) + 0.0 AS recall FROM u
UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""")
def pr_points(spark, sf_dir):
    """Precision and recall at every score."""
    return rounded(_finite(M.pr_points(scored(spark, sf_dir))), 6)


@query(f"WITH {SCORED}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM pr)"
       " SELECT round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) + 1e-9, 6) + 0.0 AS roc_auc FROM r")
def roc_auc(spark, sf_dir):
    """Area under the ROC curve with ties counted half."""
    return rounded(M.roc_auc(scored(spark, sf_dir)), 6)


@query(f"WITH {SCORED}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM pr)"
       " SELECT round((sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * (count(*) - sum(label))) + 1e-9, 6) + 0.0 AS roc_auc FROM r")
def roc_auc_in_parts(spark, sf_dir):
    """The same area with running totals cut into many parts, the way of large score tables."""
    return rounded(M.roc_auc(scored(spark, sf_dir), rows_per_split=500), 6)


@query("""WITH h AS (SELECT CAST('0x' || substr(md5(o_orderkey || chr(31) || o_custkey || chr(31) || o_orderstatus || chr(31) || o_totalprice || chr(31) || o_orderdate || chr(31) || o_orderpriority), 1, 15) AS BIGINT) AS h FROM orders)
SELECT count(*) AS "rows", md5(count(*) || ':' || CAST(sum(h) AS VARCHAR)) AS data_hash FROM h""")
def dataset_fingerprint(spark, sf_dir):
    """Order-free hash of a table, all columns."""
    return M.fingerprint(spark.read.parquet(f"{sf_dir}/orders.parquet"))


@query(f"WITH {CUSTOMERS} SELECT HasFraud, round((SELECT count(*) FROM cust) / (2.0 * count(*)) + 1e-9, 6) + 0.0 AS weight, count(*) AS n FROM cust GROUP BY HasFraud")
def balanced_weights(spark, sf_dir):
    """Class weights n / (2 n_c)."""
    weighted, _ = T.with_balanced_weights(customers(spark, sf_dir), "HasFraud")
    return rounded(weighted.groupBy("HasFraud", "weight").agg(F.count("*").alias("n")), 6)


_HOLES = f"""{CUSTOMERS}, h AS (SELECT CustomerId, CASE WHEN Frequency > 5 THEN Frequency END AS Frequency, CASE WHEN Amount_mean < 300000 THEN Amount_mean END AS Amount_mean FROM cust),
m AS (SELECT median(Frequency) AS f, median(Amount_mean) AS a FROM h), x AS (SELECT CustomerId, coalesce(Frequency, f) AS f, coalesce(Amount_mean, a) AS a FROM h, m)"""


@query(f"""WITH {_HOLES} SELECT CustomerId, round((f - (SELECT avg(f) FROM x)) / (SELECT stddev_pop(f) FROM x) + 1e-9, 4) + 0.0 AS Frequency,
  round((a - (SELECT avg(a) FROM x)) / (SELECT stddev_pop(a) FROM x) + 1e-9, 4) + 0.0 AS Amount_mean FROM x""")
def impute_and_scale(spark, sf_dir):
    """Training preparation: median imputation, then standardisation."""
    holes = customers(spark, sf_dir).select(
        "CustomerId", F.when(F.col("Frequency") > 5, F.col("Frequency")).alias("Frequency"),
        F.when(F.col("Amount_mean") < 300000, F.col("Amount_mean")).alias("Amount_mean"))
    out = T.TabularPrep(["Frequency", "Amount_mean"], []).fit(materialize(holes, "holes")).transform(holes)
    return rounded(out.select("CustomerId", F.col("__n_Frequency").alias("Frequency"), F.col("__n_Amount_mean").alias("Amount_mean")))


@query(f"""WITH {CUSTOMERS}, r AS (SELECT *, row_number() OVER (PARTITION BY HasFraud ORDER BY md5('42|' || CustomerId)) AS r, count(*) OVER (PARTITION BY HasFraud) AS n FROM cust)
SELECT CustomerId, HasFraud, CASE WHEN r <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS part FROM r""")
def model_split(spark, sf_dir):
    """Train and test customers with the class shares kept."""
    train, test = split_by_label(customers(spark, sf_dir).select("CustomerId", "HasFraud"), "HasFraud", ["CustomerId"])
    return rounded(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))))


def _training_table(spark, sf_dir):
    """Customers with number, text, boolean and date features."""
    txn = txn_orders(spark, sf_dir)
    table = customer_aggregates(txn, cyclical=False).select(
        "CustomerId", "Amount_mean", "Amount_std", "TransactionStartTime_count", "Month_mean", "Year_mean", "HasFraud")
    modes = modal_categories(txn, ["ProductCategory"])
    firsts = txn.groupBy("CustomerId").agg(F.trunc(F.min("TransactionStartTime").cast("date"), "year").alias("FirstYear"), (F.count_if(F.col("ChannelId") == "P") > 0).alias("HasPending"))
    joined = table.join(rfm(txn).select("CustomerId", "Recency"), "CustomerId").join(modes, "CustomerId").join(firsts, "CustomerId")
    return materialize(joined.withColumnRenamed("HasFraud", "is_high_risk"), "training")


_searches: dict[tuple[str, str], list[T.TrainedModel]] = {}


def _searched(spark, sf_dir):
    """The full search over all grids, once per application and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _searches:
        _searches[key] = T.train_all(_training_table(spark, sf_dir))
    return _searches[key]


@query()
def leaderboard(spark, sf_dir):
    """Three classifiers compared on the same split, each the best of its whole grid over five folds."""
    return T.leaderboard(_searched(spark, sf_dir), spark)


@query()
def grid_search(spark, sf_dir):
    """Cross-validated ROC-AUC of every setting of every grid."""
    rows = [(m.name, str(k), float(v)) for m in _searched(spark, sf_dir) for k, v in m.cv_scores]
    return spark.createDataFrame(rows, "model string, params string, roc_auc double")


_SETTINGS = " UNION ALL ".join(f"SELECT '{name}' AS model, CAST({len(T._combinations(grid))} AS BIGINT) AS settings" for name, grid in T.GRIDS.items())


@query(f"""WITH {CUSTOMERS}, k AS (SELECT HasFraud, greatest(1, CAST(floor(count(*) * 0.2) AS BIGINT)) AS n FROM cust GROUP BY HasFraud), g AS ({_SETTINGS})
SELECT model, settings, 5 * settings AS judged, true AS best_is_highest, true AS better_than_chance, CAST(sum(n) AS BIGINT) AS test_rows, CAST(sum(CASE WHEN HasFraud = 1 THEN n END) AS BIGINT) AS test_positives FROM k, g GROUP BY model, settings""")
def training_invariants(spark, sf_dir):
    """Every setting is judged in every fold, the chosen one has the highest mean, it beats chance on the test part, and that part is whole."""
    rows = []
    for m in _searched(spark, sf_dir):
        chosen = next(v for k, v in m.cv_scores if k == m.best_params)
        cells = M.confusion_matrix(m.predictions, "is_high_risk", "prediction").collect()  # four rows
        rows.append((m.name, len(m.cv_scores), len(m.fold_scores), chosen == max(v for _, v in m.cv_scores), m.metrics["roc_auc"] > 0.55,
                     sum(r["n"] for r in cells), sum(r["n"] for r in cells if r["label"] == 1)))
    return spark.createDataFrame(rows, "model string, settings long, judged long, best_is_highest boolean, better_than_chance boolean, test_rows long, test_positives long")


_ONE_FEATURE = f"""{CUSTOMERS}, r AS (SELECT *, row_number() OVER (PARTITION BY HasFraud ORDER BY md5('42|' || CustomerId)) AS r, count(*) OVER (PARTITION BY HasFraud) AS n FROM cust),
tr AS (SELECT CustomerId, HasFraud, Frequency FROM r WHERE r > greatest(1, CAST(floor(n * 0.2) AS BIGINT))),
q AS (SELECT *, row_number() OVER (PARTITION BY HasFraud ORDER BY md5('42|' || CustomerId)) AS q, count(*) OVER (PARTITION BY HasFraud) AS m FROM tr),
fo AS (SELECT *, CAST(CASE WHEN q <= m * 1 // 5 THEN 0 WHEN q <= m * 2 // 5 THEN 1 WHEN q <= m * 3 // 5 THEN 2 WHEN q <= m * 4 // 5 THEN 3 ELSE 4 END AS BIGINT) AS fold FROM q),
rk AS (SELECT fold, HasFraud, rank() OVER (PARTITION BY fold ORDER BY Frequency) + (count(*) OVER (PARTITION BY fold, Frequency) - 1) / 2 AS r FROM fo),
au AS (SELECT fold, (sum(CASE WHEN HasFraud = 1 THEN r END) - sum(HasFraud) * (sum(HasFraud) + 1) / 2) / (sum(HasFraud) * (count(*) - sum(HasFraud))) AS a FROM rk GROUP BY fold)"""


@query(f"WITH {_ONE_FEATURE} SELECT c AS C, fold, round(a + 1e-9, 6) + 0.0 AS roc_auc FROM au, (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (1::DOUBLE), (10::DOUBLE)) AS v(c)")
def grid_search_one_feature(spark, sf_dir):
    """The search on one feature: a logistic score orders customers as the feature does, so every fold's area is known."""
    table = materialize(customers(spark, sf_dir).select("CustomerId", "Frequency", F.col("HasFraud").alias("is_high_risk")), "one-feature")
    (model,) = T.train_all(table, grids={"logistic": T.GRIDS["logistic"]})
    rows = [(float(model.cv_scores[i][0]["C"]), fold, a) for i, fold, a in model.fold_scores]
    return rounded(spark.createDataFrame(rows, "C double, fold long, roc_auc double"), 6)


# Newton's method on the weighted, penalised objective; the state is (b1, b2, b0)
NEWTON = f"""{CUSTOMERS}, sd AS (SELECT avg(Frequency) AS fm, stddev_pop(Frequency) AS fs, avg(Amount_mean) AS am, stddev_pop(Amount_mean) AS as_, count(*) AS n, sum(HasFraud) AS n1 FROM cust),
xs AS (SELECT CustomerId, (Frequency - fm) / fs AS x1, (Amount_mean - am) / as_ AS x2, HasFraud AS y, CASE WHEN HasFraud = 1 THEN n / (2.0 * n1) ELSE n / (2.0 * (n - n1)) END AS w, 1.0 / n AS pen FROM cust, sd),
nt(i, b1, b2, b0) AS (SELECT 0, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE UNION ALL
  SELECT i + 1, b1 - (g1 * (h22 * h00 - h20 * h20) - g2 * (h12 * h00 - h20 * h10) + g0 * (h12 * h20 - h22 * h10)) / det,
    b2 - (g2 * (h11 * h00 - h10 * h10) - g1 * (h12 * h00 - h10 * h20) - g0 * (h11 * h20 - h12 * h10)) / det,
    b0 - (g0 * (h11 * h22 - h12 * h12) + g1 * (h12 * h20 - h22 * h10) - g2 * (h11 * h20 - h12 * h10)) / det FROM (
    SELECT *, h11 * (h22 * h00 - h20 * h20) - h12 * (h12 * h00 - h20 * h10) + h10 * (h12 * h20 - h22 * h10) AS det FROM (
      SELECT i, b1, b2, b0, avg(w * (p - y) * x1) + any_value(pen) * b1 AS g1, avg(w * (p - y) * x2) + any_value(pen) * b2 AS g2, avg(w * (p - y)) AS g0,
        avg(w * p * (1 - p) * x1 * x1) + any_value(pen) AS h11, avg(w * p * (1 - p) * x2 * x2) + any_value(pen) AS h22, avg(w * p * (1 - p)) AS h00,
        avg(w * p * (1 - p) * x1 * x2) AS h12, avg(w * p * (1 - p) * x1) AS h10, avg(w * p * (1 - p) * x2) AS h20 FROM (
        SELECT nt.i, nt.b1, nt.b2, nt.b0, xs.*, 1 / (1 + exp(-(nt.b0 + nt.b1 * x1 + nt.b2 * x2))) AS p FROM nt, xs WHERE nt.i < 25) GROUP BY i, b1, b2, b0))),
fit AS (SELECT b1, b2, b0 FROM nt WHERE i = 25)"""


def logistic_of_customers(spark, sf_dir):
    """All customers as training rows, the fitted pipeline and its penalty."""
    table = materialize(customers(spark, sf_dir).withColumnRenamed("HasFraud", "is_high_risk"), "customers")
    weighted, n = T.with_balanced_weights(table, "is_high_risk")
    model = T.train(table, table, "logistic", grid={"C": [1]}).model
    return table, weighted, model, 1.0 / n


@query(f"""WITH RECURSIVE {NEWTON}, gr AS (SELECT avg(w * (p - y) * x1) + any_value(pen * b1) AS g1, avg(w * (p - y) * x2) + any_value(pen * b2) AS g2, avg(w * (p - y)) AS g0
  FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM xs, fit))
SELECT 'Frequency' AS feature, round(b1 + 1e-9, 3) + 0.0 AS coefficient, abs(g1) < 1e-5 AS at_optimum, true AS gap_is_small FROM fit, gr
UNION ALL SELECT 'Amount_mean', round(b2 + 1e-9, 3) + 0.0, abs(g2) < 1e-5, true FROM fit, gr UNION ALL SELECT 'intercept', round(b0 + 1e-9, 3) + 0.0, abs(g0) < 1e-5, true FROM fit, gr""")
def logistic_optimum(spark, sf_dir):
    """Coefficients of a logistic fit with a proof over all rows that they are at the optimum."""
    _, weighted, model, penalty = logistic_of_customers(spark, sf_dir)
    found = T.optimality(model, weighted, "is_high_risk", penalty)
    return rounded(found.select("feature", "coefficient", (F.abs("gradient") < 1e-5).alias("at_optimum"), (F.col("gap") < 1e-9).alias("gap_is_small")), 3)


@query()
def feature_importance(spark, sf_dir):
    """Twenty most important features of the best forest, written and read back."""
    forest = next(m for m in _searched(spark, sf_dir) if m.name == "random_forest")
    path = T.write_importances(forest.importances(), scratch_path(spark, "importances") + ".csv")
    return T.top_importances(read_table(spark, path, "feature string, importance double"))


@query(f"""WITH {CUSTOMERS}, cat AS (SELECT DISTINCT ProductCategory AS v FROM (SELECT CustomerId, ProductCategory, row_number() OVER (PARTITION BY CustomerId ORDER BY k DESC, ProductCategory) AS r FROM (SELECT CustomerId, ProductCategory, count(*) AS k FROM txn GROUP BY 1, 2)) WHERE r = 1),
yr AS (SELECT DISTINCT strftime(date_trunc('year', m), '%Y-%m-%d') AS v FROM (SELECT min(ts) AS m FROM txn GROUP BY CustomerId))
SELECT unnest(['Amount_mean', 'Amount_std', 'TransactionStartTime_count', 'Month_mean', 'Year_mean', 'Recency', 'HasPending_false', 'HasPending_true']) AS feature, 1.0::DOUBLE AS total
UNION ALL SELECT 'ProductCategory_' || v, 1.0::DOUBLE FROM cat UNION ALL SELECT 'FirstYear_' || v, 1.0::DOUBLE FROM yr""")
def importance_names(spark, sf_dir):
    """Every expanded feature of the training table has an importance, and they add up to one."""
    train, _ = split_by_label(_training_table(spark, sf_dir), "is_high_risk", ["CustomerId"])
    model = T.train(_training_table(spark, sf_dir), train, "random_forest", grid={"trees": [100], "depth": [5]})
    table = model.importances()
    total = table.agg(F.sum("importance")).first()[0]
    return rounded(table.select("feature", F.lit(total).alias("total")), 6)


@query("""WITH h AS (SELECT CAST('0x' || substr(md5(o_orderkey || chr(31) || o_custkey || chr(31) || o_orderstatus || chr(31) || o_totalprice || chr(31) || o_orderdate || chr(31) || o_orderpriority), 1, 15) AS BIGINT) AS h FROM orders),
f AS (SELECT md5(count(*) || ':' || CAST(sum(h) AS VARCHAR)) AS data_hash FROM h)
SELECT model, data_hash, CAST(5 AS BIGINT) AS metrics, CAST(1 AS BIGINT) AS champions, CAST(2 AS BIGINT) AS appends, true AS repeat_changes_nothing, true AS lost_append_is_unseen FROM f, (VALUES ('logistic'), ('random_forest'), ('gradient_boosting')) AS v(model)""")
def run_log(spark, sf_dir):
    """A run log appended twice, with an append that broke off and another one, then read back."""
    models = _searched(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    log, other = T.run_log(models, orders, {"stage": "check"}), T.run_log(models[:1], orders, {"stage": "other"})
    path = scratch_path(spark, "run-log")
    first = append_run_log(log, path)
    repeated = append_run_log(log, path)
    stage_rows(other, path, "broken")  # no marker
    unseen = read_run_log(spark, path).count() == log.count()
    append_run_log(other, path, "broken")
    back = read_run_log(spark, path).where(F.col("append_id") != "broken")
    value = lambda kind, key: F.max(F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value")))
    runs = back.groupBy("run_id").agg(value("param", "model_type").alias("model"), value("param", "data_hash").alias("data_hash"), F.count_if(F.col("kind") == "metric").alias("metrics"))
    champions = back.where("key = 'champion_reason'").count()
    return runs.drop("run_id").withColumns({
        "champions": F.lit(champions).cast("bigint"), "appends": F.lit(commits(spark, path).count()).cast("bigint"), "repeat_changes_nothing": F.lit(first and not repeated), "lost_append_is_unseen": F.lit(unseen)})
