"""RFM labels, metrics, training, scoring, streaming and saved models."""

import math

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from riskloom.operators import metrics as M
from riskloom.operators import rfm as R
from riskloom.operators import score as S
from riskloom.plans import training as T
from riskloom.plans.labels import basic_features, proxy_label
from riskloom.session import scratch_path
from riskloom.sources.artifacts import ModelNotLoadedError, load_metadata, load_model, save_model
from riskloom.sources.tables import numeric_features
from riskloom.streaming.scoring import read_request_stream, score_stream, start_scoring


def test_rfm_goldens(smoke):
    rows = by_key(R.rfm(smoke))
    assert (rows["C1"]["Recency"], rows["C1"]["Frequency"], rows["C1"]["Monetary"]) == (1, 2, 150.0)
    assert (rows["C2"]["Recency"], rows["C2"]["Frequency"], rows["C2"]["Monetary"]) == (0, 2, 350.0)
    late = by_key(R.rfm(smoke, snapshot=F.lit("2025-01-01 00:00:00").cast("timestamp")))
    assert late["C1"]["Recency"] == -2  # floor of -1.54 days


def test_too_few_customers_for_clusters(smoke):
    with pytest.raises(ValueError):
        R.cluster_rfm(R.rfm(smoke), 3)


@pytest.fixture(scope="module")
def txn(spark):
    """Three groups: lapsed small buyers, regular buyers, recent heavy buyers."""
    rows = spark.range(300).select("id", (F.col("id") % 3).cast("int").alias("g"))
    n = F.element_at(F.array(F.lit(2), F.lit(6), F.lit(20)), F.col("g") + 1)
    last = F.element_at(F.array(F.lit(400), F.lit(90), F.lit(2)), F.col("g") + 1)
    many = rows.select("id", "g", F.explode(F.sequence(F.lit(1), n)).alias("i"), last.alias("last"))
    return many.select(
        F.col("id").alias("CustomerId"), (50.0 * (F.col("g") + 1) + F.col("id") % 7 + F.col("i")).alias("Amount"), F.lit(1.0).alias("Value"),
        F.timestamp_micros(F.lit(1_735_689_600_000_000) - (F.col("last") + F.col("id") % 5 + (F.col("i") - 1)) * 86_400_000_000).alias("TransactionStartTime"), "g")


def test_documented_rule_labels_the_lapsed_group(txn):
    result = proxy_label(txn)
    groups = result.labels.join(txn.select("CustomerId", "g").distinct(), "CustomerId").groupBy("g").agg(F.avg("is_high_risk").alias("share")).collect()
    assert {r["g"]: r["share"] for r in groups} == {0: 1.0, 1: 0.0, 2: 0.0}
    inverted = proxy_label(txn, rule="as_written")
    assert R.risky_cluster(inverted.clusters.centers, "as_written") != R.risky_cluster(result.clusters.centers)
    assert R.risky_cluster(result.clusters.centers, "fm_dense") == R.risky_cluster(result.clusters.centers)
    shares = {r["is_high_risk"]: r["share"] for r in result.distribution().collect()}
    assert shares == pytest.approx({0: 2 / 3, 1: 1 / 3})


def test_basic_features_carry_their_label(txn):
    table, dictionary = basic_features(txn.withColumn("kind", F.col("g").cast("string")).drop("g"))
    assert {r["is_high_risk"] for r in table.select("is_high_risk").distinct().collect()} == {0, 1}
    assert table.count() == 300 and not [n for n in table.columns if n.startswith("Velocity")]
    assert by_key(dictionary, "Feature")["is_high_risk"]["Transformation"] == "RFM clustering (KMeans) on transaction history"


def test_scores_with_tied_ranks():
    centers = [{"Recency": 1.0, "Frequency": 5.0, "Monetary": 9.0, "cluster": 0}, {"Recency": 1.0, "Frequency": 3.0, "Monetary": 9.0, "cluster": 1},
               {"Recency": 7.0, "Frequency": 1.0, "Monetary": 2.0, "cluster": 2}]
    assert R.cluster_scores(centers) == {0: 1.5 + 1 + 1.5, 1: 1.5 + 2 + 1.5, 2: 9.0}
    assert R.cluster_scores(centers, "as_written")[2] == 1 + 1 + 1
    with pytest.raises(ValueError):
        R.cluster_scores(centers, "other")


@pytest.fixture(scope="module")
def judged(spark):
    return spark.range(4_000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 0.5).otherwise((F.abs(F.hash("id")) % 90) / 100.0).alias("score"),
                                     (F.abs(F.xxhash64("id")) % 3 == 0).cast("int").alias("label")).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_auc_counts_pairs(judged):
    pdf = judged.toPandas()
    pos, neg = pdf[pdf.label == 1].score.values, pdf[pdf.label == 0].score.values
    want = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert M.roc_auc(judged, rows_per_split=10).first()[0] == pytest.approx(want)
    row = M.evaluate(judged).first()
    assert row["roc_auc"] == pytest.approx(want) and row["accuracy"] == pytest.approx((pdf.label == pdf.prediction).mean())


def test_curves_are_monotone(judged):
    roc = sorted((r["fpr"], r["tpr"]) for r in M.roc_points(judged, rows_per_split=10).collect())
    assert roc[0] == (0, 0) and roc[-1] == (1, 1) and all(a[1] <= b[1] for a, b in zip(roc, roc[1:]))
    pr = [r["recall"] for r in M.pr_points(judged).orderBy(F.desc("threshold")).collect()]
    assert pr == sorted(pr) and pr[0] == 0 and pr[-1] == 1


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    row = M.evaluate(df).first()
    assert row["precision"] == row["recall"] == row["f1"] == 0 and row["roc_auc"] is None


def test_fingerprint_ignores_order_and_sees_copies(judged):
    base = M.fingerprint(judged).first()
    assert M.fingerprint(judged.repartition(7).orderBy(F.desc("id"))).first() == base
    assert M.fingerprint(judged.unionByName(judged.where("id = 1"))).first()["data_hash"] != base["data_hash"]
    assert M.fingerprint(judged.withColumn("id", F.when(F.col("id") == 5, 6).otherwise(F.col("id")))).first()["data_hash"] != base["data_hash"]


@pytest.fixture(scope="module")
def training(spark):
    df = spark.range(600).select(
        F.col("id").alias("CustomerId"), F.when(F.col("id") % 9 != 0, F.randn(1)).alias("x"), F.randn(2).alias("noise"),
        F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").when(F.col("id") % 4 == 2, "it's").alias("cat"))
    df = df.withColumn("is_high_risk", ((F.coalesce("x", F.lit(0.0)) + F.when(F.col("cat") == "a", 1.0).otherwise(0.0) + 0.3 * F.randn(3)) > 0.4).cast("int"))
    path = scratch_path(spark, "train")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def models(training):
    grids = {"logistic": {"C": [0.1, 1]}, "random_forest": {"trees": [10], "depth": [5]}, "gradient_boosting": {"rate": [0.1], "trees": [5]}}
    return T.train_all(training, grids=grids, folds=2)


def test_models_learn_and_rank(models, spark, training):
    board = T.leaderboard(models, spark).collect()
    assert len(board) == 3 and all(0.8 < r["roc_auc"] <= 1 for r in board)
    assert board[0]["model"] == T.champion(models).name
    logistic = models[0]
    assert len(logistic.cv_scores) == 2 and logistic.best_params["C"] in (0.1, 1) and "CustomerId" not in logistic.features
    log = T.run_log(models, training, {"stage": "test"})
    assert log.where("key = 'champion_reason'").count() == 1 and log.where("key = 'data_hash'").select("value").distinct().count() == 1


def test_importances_have_plain_names(models):
    table = by_key(models[1].importances(), "feature")
    assert {"x", "noise"} <= set(table) and any(n.startswith("cat_") for n in table)
    assert sum(r["importance"] for r in table.values()) == pytest.approx(1)
    assert T.top_importances(models[1].importances(), 1).first()["feature"] == "x"
    assert models[0].importances() is None


def test_logistic_matches_newton_solution(spark, training):
    """Balanced, regularised logistic regression solved independently with numpy."""
    import numpy as np

    pdf = training.toPandas()
    train, test = T.model_split(training, "is_high_risk", ["CustomerId"])
    model = T.train(train.drop("cat"), test.drop("cat"), "logistic", grid={"C": [0.1]})
    pdf = train.toPandas()
    x = pdf[["x", "noise"]].copy()
    x["x"] = x["x"].fillna(x["x"].median())
    x = ((x - x.mean()) / x.std(ddof=0)).values
    y = pdf["is_high_risk"].values.astype(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    a, beta = np.c_[x, np.ones(len(y))], np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ beta))
        grad = 0.1 * a.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(0.1 * (a * (w * p * (1 - p))[:, None]).T @ a + penalty, grad)
    fitted = model.model.stages[-1]
    assert list(fitted.coefficients.toArray()) + [fitted.intercept] == pytest.approx(list(beta), abs=2e-4)


def test_saved_model_scores_alike(spark, training, tmp_path):
    train, test = T.model_split(training.drop("cat"), "is_high_risk", ["CustomerId"])
    fitted = T.train(train, test, "logistic", grid={"C": [1]})
    path = save_model(spark, fitted.model, fitted.features, str(tmp_path / "m"), "logistic")
    scorer = load_model(spark, path)
    assert scorer.features == fitted.features and load_metadata(spark, path)["n_features"] == 2
    wide = test.where("x is not null").select(F.col("CustomerId").cast("string").alias("customer_id"), "x", "noise")
    got = {r["customer_id"]: r["probability"] for r in S.score_wide(wide, scorer).collect()}
    for r in fitted.predictions.where("x is not null").collect():
        assert got[str(r["CustomerId"])] == pytest.approx(r["score"])
    with pytest.raises(ModelNotLoadedError):
        load_model(spark, str(tmp_path / "absent"))


def test_unknown_model_name(training):
    with pytest.raises(ValueError):
        T.train(training, training, "perceptron")


@pytest.mark.parametrize("p, category, points", [(0.0, "LOW", 0), (0.1, "LOW", 10), (0.32, "LOW", 32), (0.33, "MEDIUM", 33), (0.333, "MEDIUM", 33),
                                                 (0.5, "MEDIUM", 50), (0.65, "MEDIUM", 65), (0.66, "HIGH", 66), (0.9, "HIGH", 90), (1.0, "HIGH", 100), (0.125, "LOW", 12)])
def test_bands(spark, p, category, points):
    row = spark.range(1).select(S.risk_category(F.lit(p)).alias("c"), S.risk_score(F.lit(p)).alias("s"), S.recommendation(F.lit(category)).alias("r")).first()
    assert (row["c"], row["s"]) == (category, points) and row["r"] == S.RECOMMENDATIONS[category]


def test_default_recommendation(spark):
    assert spark.range(1).select(S.recommendation(F.lit("OTHER"))).first()[0] == "Review required"


SCORER = S.LinearScorer({"Year_mean": 0.0, "Month_mean": 0.5}, -4.0, "toy")
REQUESTS = [("A", {"Year_mean": "2019", "Month_mean": "8"}), (None, {"Year_mean": "2019", "Month_mean": "10", "Extra": "1"}), ("M", {"Year_mean": "2019"}),
            ("E", {}), ("U", {"Other": "1"}), ("N", {"Year_mean": "2019", "Month_mean": "x"})]


def test_request_cases(spark):
    scored = S.score_requests(numeric_features(spark.createDataFrame(REQUESTS, "customer_id string, features map<string,string>")), SCORER)
    rows = {r["customer_id"]: r for r in scored.collect()}
    assert rows["A"]["probability"] == 0.5 and rows["A"]["predicted_class"] == 1 and rows["A"]["risk_score"] == 50 and rows["A"]["model"] == "toy"
    assert rows[None]["probability"] == pytest.approx(1 / (1 + math.exp(-1))) and rows[None]["extra_features"] == ["Extra"]
    assert rows["M"]["error"] == "Missing required features: [Month_mean]" and rows["M"]["probability"] is None and rows["M"]["risk_category"] is None
    assert "Year_mean, Month_mean" in rows["E"]["error"] and rows["U"]["extra_features"] == ["Other"] and rows["U"]["error"]
    assert rows["N"]["error"] == "Input contains NaN values for features: [Month_mean]"
    summary = S.batch_summary(scored).first()
    assert (summary["records"], summary["successful"], summary["failed"]) == (6, 2, 4)
    checks = by_key(S.response_checks(scored), "rule")
    assert checks["customer_id present"]["failures"] == 1 and checks["probability in [0, 1]"]["failures"] == 0
    assert by_key(S.category_summary(scored), "risk_category")["MEDIUM"]["share"] == pytest.approx(1 / 6)


def test_hard_labels(spark):
    df = numeric_features(spark.createDataFrame([("A", {"x": "1"}), ("B", {"x": "-1"})], "customer_id string, features map<string,string>"))
    rows = by_key(S.score_requests(df, S.HardLabelScorer(["x"], lambda d: F.col("x") > 0)), "customer_id")
    assert (rows["A"]["probability"], rows["A"]["risk_category"], rows["A"]["risk_score"]) == (None, "HIGH", 100)
    assert (rows["B"]["predicted_class"], rows["B"]["risk_category"], rows["B"]["risk_score"]) == (0, "LOW", 0)


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"customer_id": "A", "features": {"Year_mean": 2019, "Month_mean": 8}}\n{"customer_id": "B", "features": {"Year_mean": 1}}\n')
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        start_scoring(score_stream(read_request_stream(spark, str(folder)), SCORER), out, state).awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 2
    (folder / "b.json").write_text('{"customer_id": "C", "features": {"Year_mean": 2019, "Month_mean": 9}}\n{broken\n')
    run()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 4 and sum(r["error"] == "Malformed record" for r in rows) == 1
    assert {r["customer_id"]: r["probability"] for r in rows if r["error"] is None}["A"] == 0.5


def test_nan_and_null_share_the_missing_bin(spark):
    from riskloom.operators.woe import Woe

    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 1), (2, nan, 0), (3, None, 1), (4, 1.0, 0), (5, 1.0, 1), (6, 1.0, 0)], "id long, x double, y int")
    model = Woe(["x"], "y", 5, "id").fit(df)
    bins = {r["bin"]: (r["good"], r["bad"]) for r in model.table.collect()}
    assert bins == {"__NA__": (1.0, 2.0), "1.0": (2.0, 1.0)}
    woe = {r["id"]: r["x_woe"] for r in model.transform(df).collect()}
    assert woe[1] == woe[2] == woe[3] != woe[4]


def test_unknown_text_has_no_slot_and_no_column_is_lost(spark):
    from pyspark.ml import Pipeline
    from riskloom.plans.training import prep_stages, route_columns

    rows = [(1, 1.0, "a", True, "2024-01-01", 0), (2, 2.0, "b", False, "2024-01-02", 1), (3, 3.0, "a", True, "2024-01-01", 1)]
    df = spark.createDataFrame(rows, "CustomerId long, n double, t string, flag boolean, d string, y int").selectExpr("CustomerId", "n", "t", "flag", "cast(d as date) d", "y")
    numeric, text = route_columns(df, "y", ["CustomerId"])
    assert (numeric, sorted(text)) == (["n"], ["d", "flag", "t"])
    model = Pipeline(stages=prep_stages(numeric, text)).fit(df)
    other = spark.createDataFrame([(9, 2.0, "unseen", None, "2030-01-01", 0)], "CustomerId long, n double, t string, flag boolean, d string, y int").selectExpr("CustomerId", "n", "t", "flag", "cast(d as date) d", "y")
    vector = model.transform(other).first()["features"].toArray()
    assert len(vector) == 1 + 2 + 2 + 2 and sum(vector[1:]) == 1  # the missing flag takes the most frequent value; unseen text and date are zeros


def test_missing_report_orders_numbers_by_size(spark):
    from riskloom.operators.profile import missing_table

    df = spark.createDataFrame([(3,), (20,), (100,), (None,), (7,)], "n int")
    assert missing_table(df).first()["Sample"] == ["3", "7", "20"]
