"""Scoring queries: every customer of a table is a request."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_ORDERS, query, rounded
from riskloom.catalog.evaluation import CUSTOMERS, INTERCEPT, NEWTON, WEIGHTS, customers, logistic_of_customers
from riskloom.operators import score as S
from riskloom.operators.rfm import rfm
from riskloom.plans import training as T
from riskloom.session import materialize, scratch_path
from riskloom.sources.artifacts import load_model, save_model
from riskloom.sources.tables import numeric_features, read_requests, read_table, write_table
from riskloom.sources.transactions import txn_orders
from riskloom.streaming.scoring import read_request_stream, score_stream as stream_scores, start_scoring

SCORER = S.LinearScorer(WEIGHTS, INTERCEPT, "closed-form")
STAMP = "2024-01-15T10:30:00"


def _requests(spark, sf_dir):
    """Every tenth customer lacks a feature, another tenth has a bad value, a third one an extra feature."""
    kind = F.col("CustomerId") % 10
    entries = F.array(
        F.struct(F.lit("Frequency").alias("k"), F.col("Frequency").cast("string").alias("v")),
        F.when(kind != 0, F.struct(F.lit("Amount_mean").alias("k"), F.when(kind == 1, "n/a").otherwise(F.col("Amount_mean").cast("string")).alias("v"))),
        F.when(kind == 2, F.struct(F.lit("Spare").alias("k"), F.lit("1").alias("v"))))
    return customers(spark, sf_dir).select(F.col("CustomerId").cast("string").alias("customer_id"), F.map_from_entries(F.array_compact(entries)).alias("features"))


_P = "1 / (1 + exp(-(-8.0 + 0.3 * Frequency + 0.00002 * Amount_mean)))"
_REQ = f"""{CUSTOMERS}, req AS (SELECT CAST(CustomerId AS VARCHAR) AS customer_id, Frequency, Amount_mean, {_P} AS p0, CustomerId % 10 AS kind FROM cust),
s AS (SELECT *, CASE WHEN kind > 1 THEN p0 END AS p,
  CASE WHEN kind = 0 THEN 'Missing required features: [Amount_mean]' WHEN kind = 1 THEN 'Input contains NaN values for features: [Amount_mean]' END AS error FROM req),
b AS (SELECT *, CASE WHEN p < 0.33 THEN 'LOW' WHEN p < 0.66 THEN 'MEDIUM' WHEN p IS NOT NULL THEN 'HIGH' END AS risk_category FROM s)"""
_ADVICE = """CASE risk_category WHEN 'LOW' THEN 'Approve - Low risk of default' WHEN 'MEDIUM' THEN 'Review - Moderate risk, consider additional verification'
  WHEN 'HIGH' THEN 'Reject - High risk of default' END"""
_SCORED = f"""SELECT customer_id, round(p + 1e-9, 6) + 0.0 AS probability, CAST(p >= 0.5 AS BIGINT) AS predicted_class, risk_category,
  CAST(round_even(p * 100, 0) AS BIGINT) AS risk_score, {_ADVICE} AS recommendation, error FROM b"""


def _batch(spark, sf_dir):
    return S.score_requests(numeric_features(_requests(spark, sf_dir)), SCORER, timestamp=F.lit(STAMP))


def _core(df):
    return rounded(df.select("customer_id", "probability", "predicted_class", "risk_category", "risk_score", "recommendation", "error"), 6)


@query(f"WITH {_REQ} {_SCORED}")
def batch_score(spark, sf_dir):
    """Batch scoring: good records get a score, bad ones an error."""
    return _core(_batch(spark, sf_dir))


@query(f"WITH {_REQ} SELECT customer_id, error, CASE WHEN kind = 2 THEN 'Spare' ELSE '' END AS extra FROM b")
def score_errors(spark, sf_dir):
    """Missing, bad and extra features per record."""
    checked = S.check_requests(numeric_features(_requests(spark, sf_dir)), SCORER.features)
    return checked.select("customer_id", "error", F.array_join("extra_features", ",").alias("extra"))


@query(f"""WITH {CUSTOMERS} SELECT CustomerId, CASE WHEN {_P} < 0.2 THEN 'LOW' WHEN {_P} < 0.8 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category,
  CAST(round_even({_P} * 100, 0) AS BIGINT) AS risk_score FROM cust""")
def risk_bands(spark, sf_dir):
    """Category and score with configured thresholds."""
    scored = SCORER.apply(customers(spark, sf_dir))
    return rounded(scored.select("CustomerId", S.risk_category(F.col("__p"), S.RiskBands(0.2, 0.8)).alias("risk_category"), S.risk_score(F.col("__p")).alias("risk_score")))


@query(f"""WITH {CUSTOMERS} SELECT CAST(CustomerId AS VARCHAR) AS customer_id, CAST(NULL AS DOUBLE) AS probability, CAST(Frequency > 12 AS BIGINT) AS predicted_class,
  CASE WHEN Frequency > 12 THEN 'HIGH' ELSE 'LOW' END AS risk_category, CAST(CASE WHEN Frequency > 12 THEN 100 ELSE 0 END AS BIGINT) AS risk_score,
  CASE WHEN Frequency > 12 THEN 'Reject - High risk of default' ELSE 'Approve - Low risk of default' END AS recommendation, CAST(NULL AS VARCHAR) AS error FROM cust""")
def hard_label_score(spark, sf_dir):
    """A model without probabilities."""
    scorer = S.HardLabelScorer(["Frequency"], lambda df: F.col("Frequency") > 12)
    return _core(S.score_requests(numeric_features(_requests(spark, sf_dir)), scorer, timestamp=F.lit(STAMP)))


@query(f"WITH {_REQ} SELECT count(*) AS records, count(p) AS successful, count(*) - count(p) AS failed, round(avg(p) + 1e-9, 6) + 0.0 AS avg_probability FROM b")
def batch_summary(spark, sf_dir):
    """Scored, failed and mean probability of a batch."""
    return rounded(S.batch_summary(_batch(spark, sf_dir)), 6)


@query(f"WITH {_REQ} SELECT risk_category, count(*) AS customers, round(count(*) / (SELECT count(*) FROM b) + 1e-9, 6) + 0.0 AS share FROM b WHERE risk_category IS NOT NULL GROUP BY 1")
def category_summary(spark, sf_dir):
    """Customers and share per category."""
    return rounded(S.category_summary(_batch(spark, sf_dir)), 6)


_RULES = [f"{n} present" for n in S.RESPONSE_FIELDS] + ["probability in [0, 1]", "predicted_class in {0, 1}", "risk_score in [0, 100]"]


@query(f"WITH {_REQ}, n AS (SELECT count(CASE WHEN error IS NULL AND p IS NULL THEN 1 END) AS bad FROM b) " + " UNION ALL ".join(f"SELECT '{r}' AS rule, bad AS failures FROM n" for r in _RULES))
def response_checks(spark, sf_dir):
    """Failing records per response rule."""
    return S.response_checks(_batch(spark, sf_dir))


_BAD = f"""{_REQ}, g AS (SELECT * FROM b WHERE error IS NULL), k AS (SELECT CAST(customer_id AS BIGINT) % 50 AS k FROM g)"""
_BAD_RULES = {"probability in [0, 1]": "k = 3", "predicted_class in {0, 1}": "k = 4", "risk_score in [0, 100]": "k IN (5, 6)", "recommendation present": "k = 7", "model present": "k = 8"}


@query(f"WITH {_BAD} " + " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER ({_BAD_RULES.get(r, 'false')}) AS failures FROM k" for r in _RULES))
def response_checks_of_bad_rows(spark, sf_dir):
    """The same rules on responses that were spoilt on purpose."""
    k = F.col("customer_id").cast("bigint") % 50
    spoilt = _batch(spark, sf_dir).withColumns({
        "probability": F.when(k == 3, 1.5).otherwise(F.col("probability")), "predicted_class": F.when(k == 4, 7).otherwise(F.col("predicted_class")),
        "risk_score": F.when(k == 5, 101).when(k == 6, -1).otherwise(F.col("risk_score")), "recommendation": F.when(k != 7, F.col("recommendation")), "model": F.when(k != 8, F.col("model"))})
    return S.response_checks(spoilt)


@query(f"WITH {_REQ} {_SCORED}")
def json_requests(spark, sf_dir):
    """Requests written as JSON records, read back and scored."""
    path = write_table(_requests(spark, sf_dir), scratch_path(spark, "requests") + ".json")
    return _core(S.score_requests(numeric_features(read_requests(spark, path)), SCORER, timestamp=F.lit(STAMP)))


@query(f"""WITH {_REQ}, w AS (SELECT customer_id, Frequency, Amount_mean, p0 AS p, CASE WHEN p0 < 0.33 THEN 'LOW' WHEN p0 < 0.66 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category FROM req)
SELECT customer_id, round(p + 1e-9, 6) + 0.0 AS probability, CAST(p >= 0.5 AS BIGINT) AS predicted_class, risk_category, CAST(round_even(p * 100, 0) AS BIGINT) AS risk_score,
  {_ADVICE} AS recommendation, CAST(NULL AS VARCHAR) AS error, round(Frequency + 1e-9, 4) + 0.0 AS Frequency, round(Amount_mean + 1e-9, 4) + 0.0 AS Amount_mean FROM w""")
def wide_csv_scoring(spark, sf_dir):
    """A csv with one column per feature, scored with its features echoed."""
    wide = customers(spark, sf_dir).select(F.col("CustomerId").alias("customer_id"), "Frequency", "Amount_mean")
    path = write_table(wide, scratch_path(spark, "wide") + ".csv")
    out = S.score_wide(read_table(spark, path, "customer_id string, Frequency double, Amount_mean double"), SCORER)
    return rounded(out.drop("model", "timestamp", "extra_features"), 6, Frequency=4, Amount_mean=4)


_BLANKS = f"""{CUSTOMERS}, w AS (SELECT 'CUST_' || lpad(CAST(row_number() OVER (ORDER BY CustomerId) AS VARCHAR), CAST(greatest(4, length(CAST(row_number() OVER (ORDER BY CustomerId) AS VARCHAR))) AS INTEGER), '0') AS customer_id,
  Frequency, Amount_mean, CustomerId % 8 = 3 AS blank, {_P} AS p FROM cust)"""


@query(f"""WITH {_BLANKS} SELECT customer_id, CASE WHEN NOT blank THEN round(p + 1e-9, 6) + 0.0 END AS probability, CASE WHEN NOT blank THEN CAST(p >= 0.5 AS BIGINT) END AS predicted_class,
  CASE WHEN blank THEN 'Missing required features: [Amount_mean]' END AS error, CASE WHEN NOT blank THEN round(Amount_mean + 1e-9, 4) + 0.0 END AS Amount_mean FROM w""")
def wide_csv_blank_cells(spark, sf_dir):
    """A csv without ids and with blank cells: rows are numbered, and blank features are missing ones."""
    wide = customers(spark, sf_dir).orderBy("CustomerId").select("Frequency", F.when(F.col("CustomerId") % 8 != 3, F.col("Amount_mean")).alias("Amount_mean"))
    path = write_table(wide.coalesce(1), scratch_path(spark, "wide") + ".csv")
    out = S.score_wide(read_table(spark, path, "Frequency double, Amount_mean double"), SCORER)
    return rounded(out.select("customer_id", "probability", "predicted_class", "error", "Amount_mean"), 6, Amount_mean=4)


@query(f"WITH {_REQ} {_SCORED}")
def score_stream(spark, sf_dir):
    """The same records scored by a stream over a folder of JSON files."""
    source = write_table(_requests(spark, sf_dir), scratch_path(spark, "stream-in") + ".json")
    target, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    start_scoring(stream_scores(read_request_stream(spark, source), SCORER), target, state).awaitTermination()
    return _core(spark.read.parquet(target))


def _reloaded(spark, model, name):
    """The model saved, read back and compiled."""
    path = save_model(spark, model.model, model.features, scratch_path(spark, "model"), name)
    return load_model(spark, path).compiled(spark)


_FITTED = """SELECT CAST(CustomerId AS VARCHAR) AS customer_id, round({p} + 1e-9, {digits}) + 0.0 AS probability, CAST({p} >= 0.5 AS BIGINT) AS predicted_class,
  CASE WHEN {p} < 0.33 THEN 'LOW' WHEN {p} < 0.66 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_category FROM {rows}"""


def _fitted_scores(df, digits):
    return rounded(df.select("customer_id", "probability", "predicted_class", "risk_category"), digits)


_NEWTON_P = f"WITH RECURSIVE {NEWTON}, pp AS (SELECT CustomerId, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM xs, fit) " + _FITTED.format(p="p", rows="pp", digits=3)


@query(_NEWTON_P)
def model_reload_score(spark, sf_dir):
    """A fitted logistic pipeline saved, reloaded, compiled and applied to every customer."""
    table, _, model, _ = logistic_of_customers(spark, sf_dir)
    path = save_model(spark, model, ["Frequency", "Amount_mean"], scratch_path(spark, "model"), "logistic")
    scorer = load_model(spark, path).compiled(spark)
    return _fitted_scores(S.score_wide(table.drop("is_high_risk").withColumnRenamed("CustomerId", "customer_id"), scorer), 3)


@query(_NEWTON_P)
def model_stream_score(spark, sf_dir):
    """The same fitted model over a stream of JSON records."""
    table, _, model, _ = logistic_of_customers(spark, sf_dir)
    scorer = load_model(spark, save_model(spark, model, ["Frequency", "Amount_mean"], scratch_path(spark, "model"), "logistic")).compiled(spark)
    entries = F.map_from_arrays(F.array(F.lit("Frequency"), F.lit("Amount_mean")), F.array(F.col("Frequency").cast("string"), F.col("Amount_mean").cast("string")))
    source = write_table(table.select(F.col("CustomerId").cast("string").alias("customer_id"), entries.alias("features")), scratch_path(spark, "stream-in") + ".json")
    target, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    start_scoring(stream_scores(read_request_stream(spark, source), scorer), target, state).awaitTermination()
    return _fitted_scores(spark.read.parquet(target), 3)


def _ruled(spark, sf_dir):
    """Customers whose label follows from two features of few values, so that trees can learn it without error."""
    txn = txn_orders(spark, sf_dir)
    table = rfm(txn).select("CustomerId", F.least("Frequency", F.lit(20)).alias("Orders"), F.least(F.floor(F.col("Recency") / 100), F.lit(15)).alias("Hundreds"))
    return materialize(table.withColumn("is_high_risk", ((F.col("Orders") > 9) & (F.col("Hundreds") <= 1)).cast("int")), "ruled")


_RULED = f"""{TXN_ORDERS}, c AS (SELECT CustomerId, least(count(ts), 20) AS orders, least(floor((max(epoch_us(max(ts))) OVER () - epoch_us(max(ts))) / 86400000000 / 100), 15) AS hundreds FROM txn GROUP BY CustomerId),
y AS (SELECT CustomerId, orders > 9 AND hundreds <= 1 AS y FROM c)"""


@query(f"WITH {_RULED}, pp AS (SELECT CustomerId, CASE WHEN y THEN 1.0 ELSE 0.0 END AS p FROM y) " + _FITTED.format(p="p", rows="pp", digits=6))
def forest_reload_score(spark, sf_dir):
    """A forest of one full tree on a label that it can learn without error, saved, reloaded and compiled."""
    table = _ruled(spark, sf_dir)
    (model,) = T.train_all(table, grids={"random_forest": {"trees": [1], "depth": [None]}})
    return _fitted_scores(S.score_wide(table.drop("is_high_risk").withColumnRenamed("CustomerId", "customer_id"), _reloaded(spark, model, "forest")), 6)


# each tree splits the classes without error, so every customer of a class has the same margin after each step
_MARGIN = "bo(t, f) AS (SELECT 1, 1::DOUBLE UNION ALL SELECT t + 1, f + 0.1 * 4 / (1 + exp(2 * f)) FROM bo WHERE t < 20)"


@query(f"WITH RECURSIVE {_RULED}, {_MARGIN}, pp AS (SELECT CustomerId, CASE WHEN y THEN 1 / (1 + exp(-2 * f)) ELSE 1 / (1 + exp(2 * f)) END AS p FROM y, bo WHERE t = 20) " + _FITTED.format(p="p", rows="pp", digits=6))
def boosting_reload_score(spark, sf_dir):
    """Twenty boosted trees on the same label, saved, reloaded and compiled."""
    table = _ruled(spark, sf_dir)
    (model,) = T.train_all(table, grids={"gradient_boosting": {"rate": [0.1], "trees": [20]}})
    return _fitted_scores(S.score_wide(table.drop("is_high_risk").withColumnRenamed("CustomerId", "customer_id"), _reloaded(spark, model, "boosting")), 6)
