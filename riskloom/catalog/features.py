"""Customer feature queries over whole tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_EVENTS, TXN_LINES, TXN_ORDERS, TXN_ORDERS_SEGMENT, query, rounded
from riskloom.functions.exprs import c
from riskloom.operators import aggregate as A
from riskloom.operators import temporal as T
from riskloom.operators.calendar import calendar_features as calendar_projection
from riskloom.operators.encode import CategoryEncoder, category_shares
from riskloom.operators.normalize import Normalizer
from riskloom.operators.woe import Woe, bin_counts, information_values, iv_strength, woe_of_counts
from riskloom.plans.dictionary import feature_dictionary as feature_dictionary_of
from riskloom.plans.features import BASIC, FeatureConfig, build_features, fit_features
from riskloom.session import materialize, scratch_path
from riskloom.sources.tables import read_table, write_features
from riskloom.sources.transactions import txn_events, txn_lines, txn_orders


def _skew_sql(x: str) -> str:
    return f"CASE WHEN count({x}) < 3 THEN NULL WHEN stddev_pop({x}) = 0 THEN 0.0 ELSE round(skewness({x}) + 1e-9, 4) + 0.0 END"


def _stats_sql(name: str, x: str) -> str:
    return f"""round(sum({x}) + 1e-9, 2) + 0.0 AS "{name}_sum", round(avg({x}) + 1e-9, 4) + 0.0 AS "{name}_mean", round(max({x}) + 1e-9, 4) + 0.0 AS "{name}_max",
  round(stddev_samp({x}) + 1e-9, 4) + 0.0 AS "{name}_std", {_skew_sql(x)} AS "{name}_skew" """


_DAY = 86400000000
_PERIOD = f"CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / {_DAY}) AS BIGINT) + 1"
_RECENT = "(SELECT max(ts) - INTERVAL 30 DAY FROM txn)"


def _recent_sql(cond: str) -> str:
    return ", ".join(
        f"""round(sum(CASE WHEN {cond} THEN {x} END) + 1e-9, 2) + 0.0 AS "Recent30_{n}_sum", round(avg(CASE WHEN {cond} THEN {x} END) + 1e-9, 4) + 0.0 AS "Recent30_{n}_mean" """
        for n, x in (("Amount", "Amount"), ("Value", '"Value"'))) + f""", nullif(count(CASE WHEN {cond} THEN 1 END), 0) AS "Recent30_TransactionStartTime_count" """


def _calendar_sql() -> str:
    h, w, m = "hour(ts)", "(isodow(ts) - 1)", "month(ts)"
    means = {"Hour": h, "Weekday": w, "Day": "day(ts)", "Month": m, "Year": "year(ts)",
             "IsWeekend": f"CAST({w} IN (5, 6) AS INT)", "IsBusinessHours": f"CAST({h} BETWEEN 9 AND 17 AS INT)",
             "Hour_sin": f"sin(2 * pi() * {h} / 24)", "Hour_cos": f"cos(2 * pi() * {h} / 24)",
             "Month_sin": f"sin(2 * pi() * {m} / 12)", "Month_cos": f"cos(2 * pi() * {m} / 12)"}
    cols = [f'round(avg({e}) + 1e-9, 4) + 0.0 AS "{n}_mean"' for n, e in means.items()]
    cols += [f'round(stddev_samp({e}) + 1e-9, 4) + 0.0 AS "{n}_std"' for n, e in (("Hour", h), ("Weekday", w))]
    return ", ".join(cols)


_AGG_SQL = f"""SELECT CustomerId, {_stats_sql("Amount", "Amount")}, {_stats_sql("Value", '"Value"')}, count(ts) AS "TransactionStartTime_count",
  {_PERIOD} AS "TransactionStartTime_period", {_recent_sql(f"ts >= {_RECENT}")}, {_calendar_sql()}, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId"""
_SUMS = {f"{p}{n}_sum": 2 for p in ("", "Recent30_") for n in ("Amount", "Value")}


@query(f"WITH {TXN_ORDERS} {_AGG_SQL}")
def customer_aggregates(spark, sf_dir):
    """All mergeable customer features of the orders table in one group-by."""
    return rounded(A.customer_aggregates(txn_orders(spark, sf_dir)), **_SUMS)


@query(f"WITH {TXN_EVENTS} {_AGG_SQL}")
def customer_aggregates_events(spark, sf_dir):
    """The same features with times of day."""
    return rounded(A.customer_aggregates(txn_events(spark, sf_dir)), **_SUMS)


@query(f"WITH {TXN_LINES} {_AGG_SQL}")
def customer_aggregates_lines(spark, sf_dir):
    """The same features from the line table joined with orders and parts."""
    # the joined rows are read twice (latest time, aggregates), so the join is done once
    return rounded(A.customer_aggregates(materialize(txn_lines(spark, sf_dir), "lines")), **_SUMS)


@query(f"WITH {TXN_ORDERS} SELECT CustomerId, {_recent_sql('true')} FROM txn WHERE ts >= {_RECENT} GROUP BY CustomerId")
def recent_activity(spark, sf_dir):
    """Aggregates of the last 30 days."""
    return rounded(A.recent_activity(txn_orders(spark, sf_dir)), **_SUMS)


@query(f"WITH {TXN_EVENTS} SELECT CustomerId, {_PERIOD} AS period, count(ts) AS transactions FROM txn GROUP BY CustomerId")
def active_period(spark, sf_dir):
    """Active period in whole elapsed days plus one."""
    return txn_events(spark, sf_dir).groupBy("CustomerId").agg(
        A.period_days(F.col("TransactionStartTime")).alias("period"), F.count("TransactionStartTime").alias("transactions"))


@query(f"WITH {TXN_EVENTS} SELECT CustomerId, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId")
def customer_target(spark, sf_dir):
    """Customer label from the transaction label."""
    return rounded(A.customer_target(txn_events(spark, sf_dir)))


@query(f"WITH {TXN_EVENTS}, t AS (SELECT CustomerId, max(FraudResult) AS y FROM txn GROUP BY 1) SELECT count(*) AS customers, round(avg(y) + 1e-9, 4) + 0.0 AS fraud_rate FROM t")
def fraud_rate(spark, sf_dir):
    """Share of customers with the label."""
    return rounded(A.fraud_rate(A.customer_target(txn_events(spark, sf_dir))))


@query(f"""WITH {TXN_EVENTS} SELECT TransactionId, hour(ts) AS "Hour", isodow(ts) - 1 AS Weekday, day(ts) AS "Day", month(ts) AS "Month", year(ts) AS "Year",
  CAST(isodow(ts) IN (6, 7) AS BIGINT) AS IsWeekend, CAST(hour(ts) BETWEEN 9 AND 17 AS BIGINT) AS IsBusinessHours,
  round(sin(2 * pi() * hour(ts) / 24) + 1e-9, 4) + 0.0 AS Hour_sin, round(cos(2 * pi() * hour(ts) / 24) + 1e-9, 4) + 0.0 AS Hour_cos,
  round(sin(2 * pi() * month(ts) / 12) + 1e-9, 4) + 0.0 AS Month_sin, round(cos(2 * pi() * month(ts) / 12) + 1e-9, 4) + 0.0 AS Month_cos FROM txn""")
def calendar_features(spark, sf_dir):
    """Calendar parts, flags and cyclical encodings of every transaction."""
    txn = txn_events(spark, sf_dir).select("TransactionId", "TransactionStartTime")
    return rounded(calendar_projection(txn).drop("TransactionStartTime"))


@query(f"""WITH {TXN_EVENTS} SELECT CustomerId, epoch_us(ts) AS ts_micros,
  round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY CustomerId ORDER BY ts)) / {_DAY}.0 + 1e-9, 6) + 0.0 AS TimeSinceLast FROM txn""")
def days_since_previous(spark, sf_dir):
    """Days since the customer's previous transaction, per transaction."""
    out = T.days_since_previous(txn_events(spark, sf_dir))
    return rounded(out.select("CustomerId", F.unix_micros("TransactionStartTime").alias("ts_micros"), "TimeSinceLast"), 6)


@query(f"""WITH {TXN_ORDERS} SELECT CustomerId, epoch_us(ts) AS ts_micros,
  round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY CustomerId ORDER BY ts)) / {_DAY}.0 + 1e-9, 6) + 0.0 AS TimeSinceLast FROM txn""")
def days_since_previous_orders(spark, sf_dir):
    """The same with repeated times within a customer."""
    out = T.days_since_previous(txn_orders(spark, sf_dir))
    return rounded(out.select("CustomerId", F.unix_micros("TransactionStartTime").alias("ts_micros"), "TimeSinceLast"), 6)


@query(f"WITH {TXN_EVENTS} SELECT CustomerId, strftime(ts, '%Y-%m-%d') AS TransactionDate, count(*) AS transactions FROM txn GROUP BY ALL")
def daily_counts(spark, sf_dir):
    """Transactions per customer and active day."""
    return T.daily_counts(txn_events(spark, sf_dir)).withColumn("TransactionDate", F.date_format("TransactionDate", "yyyy-MM-dd"))


_DAYS_SQL = "days AS (SELECT CustomerId, CAST(ts AS DATE) AS d, count(*) AS n FROM txn GROUP BY ALL)"
_VELOCITY = f"""{_DAYS_SQL}, rolled AS (SELECT CustomerId, {", ".join(
    f"avg(n) OVER (PARTITION BY CustomerId ORDER BY d ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS v{w}" for w in (1, 7, 30))} FROM days),
velocity AS (SELECT CustomerId, {", ".join(f'round(avg(v{w}) + 1e-9, 4) + 0.0 AS "Velocity_{w}d_mean"' for w in (1, 7, 30))} FROM rolled GROUP BY CustomerId)"""


@query(f"WITH {TXN_EVENTS}, {_VELOCITY} SELECT * FROM velocity")
def velocity(spark, sf_dir):
    """Mean rolling transaction count over 1, 7 and 30 active days."""
    return rounded(T.velocity(txn_events(spark, sf_dir)))


@query(f"""WITH {TXN_EVENTS}, {_DAYS_SQL}, rolled AS (SELECT CustomerId,
  sum(n) OVER (PARTITION BY CustomerId ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) / 7.0 AS v7 FROM days)
SELECT CustomerId, round(avg(v7) + 1e-9, 4) + 0.0 AS "Velocity_7d_mean" FROM rolled GROUP BY CustomerId""")
def velocity_calendar_days(spark, sf_dir):
    """The same over seven calendar days."""
    return rounded(T.velocity(txn_events(spark, sf_dir), windows=(7,), calendar=True))


_MODES = "SELECT CustomerId, " + ", ".join(f'max(CASE WHEN p = \'{p}\' AND r = 1 THEN v END) AS "{p}_mode"' for p in ("Day", "Month", "Year")) + """
FROM (SELECT CustomerId, p, v, row_number() OVER (PARTITION BY CustomerId, p ORDER BY count(*) DESC, v) AS r FROM (
  SELECT CustomerId, 'Day' AS p, day(ts) AS v FROM txn UNION ALL SELECT CustomerId, 'Month', month(ts) FROM txn
  UNION ALL SELECT CustomerId, 'Year', year(ts) FROM txn) GROUP BY CustomerId, p, v) GROUP BY CustomerId"""


@query(f"WITH {TXN_ORDERS} {_MODES}")
def calendar_modes(spark, sf_dir):
    """Most frequent day, month and year per customer."""
    return rounded(T.calendar_modes(txn_orders(spark, sf_dir)))


_GAPS = f"""g AS (SELECT CustomerId, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY CustomerId ORDER BY ts)) / {_DAY}.0 AS gap FROM txn),
gaps AS (SELECT CustomerId, round(avg(gap) + 1e-9, 6) + 0.0 AS "TimeSinceLast_mean", round(min(gap) + 1e-9, 6) + 0.0 AS "TimeSinceLast_min",
  round(max(gap) + 1e-9, 6) + 0.0 AS "TimeSinceLast_max" FROM g GROUP BY CustomerId)"""


@query(f"WITH {TXN_EVENTS} {_AGG_SQL}")
def feature_sink(spark, sf_dir):
    """Features and dictionary written side by side, and both read back."""
    table = A.customer_aggregates(txn_events(spark, sf_dir))
    names = feature_dictionary_of(spark, [(n, "aggregate") for n in table.columns if n != "CustomerId"], {})
    features, dictionary = write_features(table, names, scratch_path(spark, "features"))
    back = read_table(spark, dictionary, names.schema).fillna("")  # empty cells of a csv are nulls
    if back.exceptAll(names).count() or names.exceptAll(back).count():
        raise ValueError("the dictionary that was read back is not the one written")
    return rounded(spark.read.parquet(features), **_SUMS)


@query(f"WITH {TXN_EVENTS}, {_GAPS} SELECT * FROM gaps")
def gap_statistics(spark, sf_dir):
    """Mean, smallest and largest gap per customer."""
    return rounded(T.gap_statistics(txn_events(spark, sf_dir)), 6)


_SIX = {f"TimeSinceLast_{s}": 6 for s in ("mean", "min", "max")}


@query(f"WITH {TXN_ORDERS}, {_GAPS}, {_VELOCITY}, modes AS ({_MODES}) SELECT * FROM modes JOIN gaps USING (CustomerId) JOIN velocity USING (CustomerId)")
def temporal_features(spark, sf_dir):
    """Modes, gaps and velocities in one chain of exchanges."""
    return rounded(T.temporal_features(txn_orders(spark, sf_dir)), **_SIX)


_CATS = ("ProductCategory", "ChannelId", "ProviderId")


def _modal_sql(cats) -> str:
    rows = " UNION ALL ".join(f"SELECT CustomerId, '{n}' AS f, {n} AS v FROM txn WHERE {n} IS NOT NULL" for n in cats)
    picks = ", ".join(f"max(CASE WHEN f = '{n}' AND r = 1 THEN v END) AS {n}" for n in cats)
    return f"""SELECT CustomerId, {picks} FROM (SELECT CustomerId, f, v, row_number() OVER (PARTITION BY CustomerId, f ORDER BY count(*) DESC, v) AS r
  FROM ({rows}) GROUP BY CustomerId, f, v) GROUP BY CustomerId"""


@query(f"WITH {TXN_ORDERS_SEGMENT} {_modal_sql(_CATS)}")
def modal_categories(spark, sf_dir):
    """Most frequent category per customer and column."""
    return A.modal_categories(txn_orders(spark, sf_dir, with_segment=True), list(_CATS))


def _modes_of_lines(spark, sf_dir, categories):
    """Lines are a join and modes read them several times: the needed columns are written once."""
    return A.modal_categories(materialize(txn_lines(spark, sf_dir).select("CustomerId", *categories), "line-categories"), categories)


@query(f"WITH {TXN_LINES} {_modal_sql(('ProductCategory', 'ProviderId'))}")
def modal_categories_many_values(spark, sf_dir):
    """The same for a column with few and one with many values."""
    return _modes_of_lines(spark, sf_dir, ["ProductCategory", "ProviderId"])


_KEYED = f"""{TXN_LINES}, k AS (SELECT *, CustomerId % 40 AS g FROM txn)"""


@query(f"WITH {_KEYED}, c AS (SELECT ProviderId, count(*) AS n FROM txn GROUP BY 1) SELECT CustomerId, g AS \"group\", round((SELECT n FROM c WHERE c.ProviderId = z.ProviderId) / (SELECT count(*) FROM txn) + 1e-9, 6) + 0.0 AS \"ProviderId_freq\", "
       f"round(count(*) OVER (PARTITION BY g) / (SELECT count(*) FROM txn) + 1e-9, 6) + 0.0 AS \"group_freq\" FROM k z")
def encode_many_categories(spark, sf_dir):
    """Frequencies of two columns with many values in one projection, on transactions."""
    txn = txn_lines(spark, sf_dir).select("CustomerId", "ProviderId", (F.col("CustomerId") % 40).cast("string").alias("group"))
    txn = materialize(txn, "keyed-lines")
    out = CategoryEncoder(["ProviderId", "group"]).fit(txn).transform(txn)
    return rounded(out.select("CustomerId", F.col("group").cast("bigint").alias("group"), "ProviderId_freq", "group_freq"), 6)


def _customer_categories(spark, sf_dir):
    return materialize(_modes_of_lines(spark, sf_dir, ["ProductCategory", "ChannelId"]), "categories")


_LINE_MODES = f"WITH {TXN_LINES}, m AS ({_modal_sql(('ProductCategory', 'ChannelId'))})"


@query(_LINE_MODES + " SELECT CustomerId, " + ", ".join(f"CAST(ChannelId = '{v}' AS BIGINT) AS \"ChannelId_{v}\"" for v in ("A", "N", "R"))
       + """, round((count(*) OVER (PARTITION BY ProductCategory)) / (count(*) OVER ()) + 1e-9, 6) + 0.0 AS "ProductCategory_freq" FROM m""")
def encode_categories(spark, sf_dir):
    """One-hot for few values, share of customers for many."""
    df = _customer_categories(spark, sf_dir)
    return rounded(CategoryEncoder(["ProductCategory", "ChannelId"]).fit(df).transform(df, ["CustomerId"]), 6)


@query(_LINE_MODES + """ SELECT 'ProductCategory' AS feature, coalesce(ProductCategory, '__NA__') AS value, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM m) + 1e-9, 6) + 0.0 AS share FROM m GROUP BY 2""")
def category_frequencies(spark, sf_dir):
    """Frozen frequency table of a category."""
    return rounded(category_shares(_customer_categories(spark, sf_dir), ["ProductCategory"]), 6)


_AGGS = f"""a AS (SELECT CustomerId, sum(Amount) AS s, avg(Amount) AS m, max(Amount) AS x, {_skew_sql("Amount").replace("round(skewness(Amount) + 1e-9, 4) + 0.0", "skewness(Amount)")} AS k FROM txn GROUP BY CustomerId),
l AS (SELECT CustomerId, ln(1 + s) AS ls, ln(1 + m) AS lm, ln(1 + x) AS lx, CASE WHEN k > -1 THEN ln(1 + k) END AS lk FROM a)"""


@query(f"WITH {TXN_EVENTS}, {_AGGS} SELECT CustomerId, " + ", ".join(
    f"round((l{k} - (SELECT avg(l{k}) FROM l)) / (SELECT stddev_pop(l{k}) FROM l) + 1e-9, 4) + 0.0 AS \"Amount_{n}_log_std\"" for k, n in (("s", "sum"), ("m", "mean"), ("x", "max"), ("k", "skew")))
       + " FROM l")
def log_standardize(spark, sf_dir):
    """log1p and standardisation with population deviations."""
    base = A.customer_aggregates(txn_events(spark, sf_dir), recent=False, calendar=False)
    names = ["Amount_sum", "Amount_mean", "Amount_max", "Amount_skew"]
    return rounded(Normalizer(names, drop_collinear=False).fit(base).transform(base, ["CustomerId"]))


@query(f"""WITH {TXN_EVENTS}, {_AGGS}, p AS (SELECT 'Amount_mean' AS column_name, abs(corr(ls, lm)) AS r FROM l UNION ALL SELECT 'Amount_max', abs(corr(ls, lx)) FROM l
  UNION ALL SELECT 'Amount_max', abs(corr(lm, lx)) FROM l UNION ALL SELECT 'Amount_skew', abs(corr(ls, lk)) FROM l
  UNION ALL SELECT 'Amount_skew', abs(corr(lm, lk)) FROM l UNION ALL SELECT 'Amount_skew', abs(corr(lx, lk)) FROM l)
SELECT 'Amount_sum' AS column_name UNION ALL SELECT column_name FROM p GROUP BY 1 HAVING max(r) <= 0.9""")
def correlation_pruning(spark, sf_dir):
    """Columns left after dropping those correlated with an earlier one."""
    base = A.customer_aggregates(txn_events(spark, sf_dir), recent=False, calendar=False)
    model = Normalizer(["Amount_sum", "Amount_mean", "Amount_max", "Amount_skew"], max_correlation=0.9).fit(base)
    return spark.createDataFrame([(n,) for n in model.stats], "column_name string")


def _labeled_categories(spark, sf_dir):
    txn = txn_orders(spark, sf_dir, with_segment=True)
    return A.modal_categories(txn, list(_CATS)).join(A.customer_target(txn), "CustomerId")


def _labeled_sql(txn_sql: str, cats: tuple[str, ...]) -> str:
    long = " UNION ALL ".join(f"SELECT CustomerId, '{n}' AS feature, coalesce({n}, '__NA__') AS bin, HasFraud FROM m JOIN y USING (CustomerId)" for n in cats)
    return f"""{txn_sql}, m AS ({_modal_sql(cats)}), y AS (SELECT CustomerId, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId), b AS ({long})"""


_LABELED = _labeled_sql(TXN_ORDERS_SEGMENT, _CATS)
_WOE = """n AS (SELECT feature, bin, CASE WHEN count(CASE WHEN HasFraud = 0 THEN 1 END) = 0 THEN 0.5 ELSE count(CASE WHEN HasFraud = 0 THEN 1 END)::DOUBLE END AS good,
  CASE WHEN count(CASE WHEN HasFraud = 1 THEN 1 END) = 0 THEN 0.5 ELSE count(CASE WHEN HasFraud = 1 THEN 1 END)::DOUBLE END AS bad FROM b WHERE bin IS NOT NULL GROUP BY feature, bin),
d AS (SELECT *, good / sum(good) OVER (PARTITION BY feature) AS dg, bad / sum(bad) OVER (PARTITION BY feature) AS db FROM n),
w AS (SELECT feature, bin, good, bad, ln(dg / db) AS woe, (dg - db) * ln(dg / db) AS iv FROM d)"""


@query(f"WITH {_LABELED}, {_WOE} SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w")
def woe_table(spark, sf_dir):
    """Weight of evidence and IV part of every category."""
    return rounded(Woe(list(_CATS), "HasFraud").fit(_labeled_categories(spark, sf_dir)).table, iv=6)


@query(f"""WITH {_LABELED}, {_WOE}, i AS (SELECT feature, sum(iv) AS iv FROM w GROUP BY feature)
SELECT feature, round(iv + 1e-9, 6) + 0.0 AS iv, CASE WHEN iv < 0.02 THEN 'none' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium' ELSE 'strong' END AS strength,
  CAST(iv >= 0.02 AS BIGINT) AS kept FROM i""")
def iv_ranking(spark, sf_dir):
    """Information value, its band and whether the feature is kept."""
    df = _labeled_categories(spark, sf_dir)
    table = woe_of_counts(bin_counts(df, {n: c(n) for n in _CATS}, "HasFraud"))
    iv = information_values(table)
    return rounded(iv.withColumns({"strength": iv_strength(F.col("iv")), "kept": (F.col("iv") >= 0.02).cast("int")}), 6)


@query(f"""WITH {_LABELED}, {_WOE} SELECT CustomerId, {", ".join(f'round(coalesce(max(CASE WHEN b.feature = {chr(39)}{n}{chr(39)} THEN woe END), 0) + 1e-9, 4) + 0.0 AS "{n}_woe"' for n in _CATS)}
FROM b LEFT JOIN w ON b.feature = w.feature AND b.bin = w.bin GROUP BY CustomerId""")
def woe_apply(spark, sf_dir):
    """WoE values joined back to customers."""
    df = _labeled_categories(spark, sf_dir)
    return rounded(Woe(list(_CATS), "HasFraud").fit(df).transform(df, keep=["CustomerId"]))


def _labeled_amounts(spark, sf_dir):
    return A.customer_aggregates(txn_orders(spark, sf_dir), recent=False, calendar=False)


_AMOUNTS = f"""{TXN_ORDERS}, a AS (SELECT CustomerId, round(sum(Amount), 2) AS s, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId)"""
_RANKED = f"""{_AMOUNTS}, r AS (SELECT *, row_number() OVER (ORDER BY s, CustomerId) AS r, count(*) OVER () AS n FROM a),
b AS (SELECT CustomerId, 'Amount_sum' AS feature, CAST(CAST(greatest(1, ceil((r - 1) * 4 / (n - 1))) AS BIGINT) AS VARCHAR) AS bin, HasFraud FROM r)"""


_NAN_BINS = f"""{TXN_ORDERS}, b AS (SELECT CustomerId, 'Group' AS feature, CASE WHEN CustomerId % 7 < 2 THEN '__NA__' ELSE CustomerId % 3 || '.0' END AS bin, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId)"""


@query(f"WITH {_NAN_BINS}, {_WOE} SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w")
def woe_missing_bin(spark, sf_dir):
    """A number with few values, NaN and nulls: both are missing and share a bin."""
    key = F.col("CustomerId")
    group = F.when(key % 7 == 0, F.lit(float("nan"))).when(key % 7 == 1, None).otherwise((key % 3).cast("double"))
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", "HasFraud", group.alias("Group"))
    return rounded(Woe(["Group"], "HasFraud", 5, "CustomerId").fit(materialize(df, "groups")).table, iv=6)


@query(f"""WITH {TXN_ORDERS_SEGMENT}, a AS (SELECT CustomerId, round(sum(Amount) + 1e-9, 4) + 0.0 AS Amount_sum FROM txn GROUP BY CustomerId), m AS ({_modal_sql(_CATS)})
SELECT CustomerId, Amount_sum, CAST(0 AS BIGINT) AS woe_columns, (SELECT count(DISTINCT ProductCategory) + count(DISTINCT ChannelId) + count(DISTINCT ProviderId) FROM m) AS one_hot_columns FROM a""")
def features_of_one_class(spark, sf_dir):
    """A label with one class has no weight of evidence: the feature table comes without those columns."""
    txn = txn_orders(spark, sf_dir, with_segment=True).withColumn("FraudResult", F.lit(0))
    model = fit_features(txn, FeatureConfig(categories=_CATS, stage_input=True))
    wide = model.features_of(model.base)
    woe, hot = (sum(n.endswith("_woe") for n in wide.columns), len(model.encoder.feature_names))
    return rounded(wide.select("CustomerId", "Amount_sum", F.lit(woe).alias("woe_columns"), F.lit(hot).alias("one_hot_columns")))


@query(f"WITH {_RANKED}, {_WOE} SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w")
def woe_numeric_bins(spark, sf_dir):
    """WoE of a numeric feature cut into rank quantiles."""
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", F.round("Amount_sum", 2).alias("Amount_sum"), "HasFraud")
    return rounded(Woe(["Amount_sum"], "HasFraud", 4, "CustomerId").fit(materialize(df, "amounts")).table, iv=6)


_SEVERAL = ("Amount_sum", "Frequency", "Holes")


def _several_numerics(spark, sf_dir):
    """A measure, a count with heavy ties, and a measure with NaN and null in a third of the rows."""
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", F.round("Amount_sum", 2).alias("Amount_sum"), F.col("TransactionStartTime_count").alias("Frequency"), "HasFraud")
    kind = F.col("CustomerId") % 6
    return materialize(df.withColumn("Holes", F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, None).otherwise(F.floor("Amount_sum") % 50)), "several")


_SEVERAL_BINS = f"""{TXN_ORDERS}, a AS (SELECT CustomerId, round(sum(Amount), 2) AS s, count(*) AS f, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId),
v AS (SELECT CustomerId, HasFraud, 'Amount_sum' AS feature, s::DOUBLE AS x FROM a UNION ALL SELECT CustomerId, HasFraud, 'Frequency', f::DOUBLE FROM a
  UNION ALL SELECT CustomerId, HasFraud, 'Holes', CAST(floor(s) AS BIGINT) % 50 FROM a WHERE CustomerId % 6 > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY x, CustomerId) AS r, count(*) OVER (PARTITION BY feature) AS n FROM v),
b AS (SELECT CustomerId, feature, CAST(CAST(greatest(1, ceil((r - 1) * 5 / (n - 1))) AS BIGINT) AS VARCHAR) AS bin, HasFraud FROM r)"""


@query(f"WITH {_SEVERAL_BINS}, {_WOE} SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w")
def woe_several_numerics(spark, sf_dir):
    """Edges of several numeric features found in the same rounds, with ties, NaN and nulls."""
    return rounded(Woe(list(_SEVERAL), "HasFraud", 5, "CustomerId").fit(_several_numerics(spark, sf_dir)).table, iv=6)


@query(f"WITH {_SEVERAL_BINS}, {_WOE} SELECT a.CustomerId, " + ", ".join(f"round(coalesce(max(CASE WHEN b.feature = '{n}' THEN woe END), 0) + 1e-9, 4) + 0.0 AS \"{n}_woe\"" for n in _SEVERAL)
       + " FROM a LEFT JOIN b ON a.CustomerId = b.CustomerId LEFT JOIN w ON b.feature = w.feature AND b.bin = w.bin GROUP BY a.CustomerId")
def woe_several_apply(spark, sf_dir):
    """WoE of several numeric features in one projection."""
    df = _several_numerics(spark, sf_dir)
    return rounded(Woe(list(_SEVERAL), "HasFraud", 5, "CustomerId").fit(df).transform(df, keep=["CustomerId"]))


@query(f"WITH {_RANKED}, {_WOE} SELECT CustomerId, round(woe + 1e-9, 4) + 0.0 AS \"Amount_sum_woe\" FROM b JOIN w USING (feature, bin)")
def woe_numeric_apply(spark, sf_dir):
    """Rank-binned WoE joined back to customers."""
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", F.round("Amount_sum", 2).alias("Amount_sum"), "HasFraud")
    df = materialize(df, "amounts")
    return rounded(Woe(["Amount_sum"], "HasFraud", 4, "CustomerId").fit(df).transform(df, keep=["CustomerId"]))


@query(f"""WITH {TXN_ORDERS}, a AS (SELECT CustomerId, count(*) AS f, max(FraudResult) AS HasFraud FROM txn GROUP BY CustomerId),
r AS (SELECT *, row_number() OVER (ORDER BY f, CustomerId) AS r, count(*) OVER () AS n FROM a),
b AS (SELECT CustomerId, 'Frequency' AS feature, CAST(CAST(greatest(1, ceil((r - 1) * 5 / (n - 1))) AS BIGINT) AS VARCHAR) AS bin, HasFraud FROM r), {_WOE}
SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w""")
def woe_tied_bins(spark, sf_dir):
    """Rank quantiles of a count with heavy ties, split by key."""
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", F.col("TransactionStartTime_count").alias("Frequency"), "HasFraud")
    return rounded(Woe(["Frequency"], "HasFraud", 5, "CustomerId").fit(materialize(df, "counts")).table, iv=6)


@query(f"""WITH {_AMOUNTS}, lim AS (SELECT min(s) AS lo, max(s) AS hi FROM a),
b AS (SELECT CustomerId, 'Amount_sum' AS feature, CAST(CAST(greatest(1, least(4, ceil((s - lo) / ((hi - lo) / 4)))) AS BIGINT) AS VARCHAR) AS bin, HasFraud FROM a, lim), {_WOE}
SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w""")
def woe_equal_width(spark, sf_dir):
    """WoE of a numeric feature cut into equal widths."""
    df = _labeled_amounts(spark, sf_dir).select("CustomerId", F.round("Amount_sum", 2).alias("Amount_sum"), "HasFraud")
    return rounded(Woe(["Amount_sum"], "HasFraud", 4, "CustomerId", "equal_width").fit(materialize(df, "amounts")).table, iv=6)


@query(f"""WITH {TXN_ORDERS_SEGMENT}, b AS ({" UNION ALL ".join(f"SELECT '{n}' AS feature, coalesce({n}, '__NA__') AS bin, FraudResult AS HasFraud FROM txn" for n in _CATS)}), {_WOE}
SELECT feature, bin, round(good + 1e-9, 4) + 0.0 AS good, round(bad + 1e-9, 4) + 0.0 AS bad, round(woe + 1e-9, 4) + 0.0 AS woe, round(iv + 1e-9, 6) + 0.0 AS iv FROM w""")
def woe_transaction_level(spark, sf_dir):
    """WoE fitted on transactions instead of customers."""
    return rounded(Woe(list(_CATS), "FraudResult").fit(txn_orders(spark, sf_dir, with_segment=True)).table, iv=6)


def _plain_features(txn_sql: str, cats: tuple[str, ...]) -> str:
    return f"""{txn_sql}, agg AS ({_AGG_SQL}), {_GAPS}, {_VELOCITY}, modes AS ({_MODES}), m AS ({_modal_sql(cats)}),
base AS (SELECT * EXCLUDE (HasFraud) FROM agg JOIN modes USING (CustomerId) JOIN gaps USING (CustomerId) JOIN velocity USING (CustomerId))"""


@query(f"WITH {_plain_features(TXN_EVENTS, ('ProductCategory',))} SELECT * FROM base")
def feature_table_numeric(spark, sf_dir):
    """Numeric part of the feature table: every aggregate and time feature."""
    model = fit_features(txn_events(spark, sf_dir))
    return rounded(model.base.select("CustomerId", *[c(n) for n in model.numeric if n != "CustomerId"]), **_SUMS, **_SIX)


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_STATUS = ("F", "O", "P")


@query(f"""WITH {_LABELED}, {_WOE}, i AS (SELECT feature FROM w GROUP BY feature HAVING sum(iv) >= 0.02),
hot AS (SELECT CustomerId, n, v FROM (SELECT CustomerId, 'ProductCategory' AS n, ProductCategory AS v FROM m UNION ALL SELECT CustomerId, 'ChannelId', ChannelId FROM m
  UNION ALL SELECT CustomerId, 'ProviderId', ProviderId FROM m)),
names AS (SELECT DISTINCT n, v FROM hot)
SELECT k.CustomerId, names.n || '_' || names.v AS feature, round(CAST(hot.v = names.v AS DOUBLE) + 1e-9, 4) + 0.0 AS value FROM m k CROSS JOIN names JOIN hot ON hot.CustomerId = k.CustomerId AND hot.n = names.n
UNION ALL SELECT b.CustomerId, b.feature || '_woe', round(coalesce(w.woe, 0) + 1e-9, 4) + 0.0 FROM b JOIN i USING (feature) LEFT JOIN w ON b.feature = w.feature AND b.bin = w.bin""")
def feature_table_encoded(spark, sf_dir):
    """Encoded part of the feature table in long form: one-hot columns and kept WoE features."""
    model = fit_features(txn_orders(spark, sf_dir, with_segment=True), FeatureConfig(categories=_CATS, stage_input=True))
    wide = model.features_of(model.base)
    names = model.encoder.feature_names + [f"{n}_woe" for n in model.woe_features]
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), c(n).cast("double").alias("value")) for n in names])
    return rounded(wide.select("CustomerId", F.inline(pairs)))


def _norm_sql(kept: dict[str, str]) -> str:
    """Standardised logs of the kept columns, given as name -> column of ``raw``."""
    return f"""raw AS (SELECT CustomerId, sum(Amount) AS s, avg(Amount) AS m, max(Amount) AS x, max("Value") AS vx,
  CASE WHEN count(Amount) < 3 THEN NULL WHEN stddev_pop(Amount) = 0 THEN 0.0 ELSE skewness(Amount) END AS k,
  sum(CASE WHEN ts >= {_RECENT} THEN Amount END) AS rs, avg(CASE WHEN ts >= {_RECENT} THEN Amount END) AS rm,
  nullif(count(CASE WHEN ts >= {_RECENT} THEN 1 END), 0) AS rc FROM txn GROUP BY CustomerId),
logs AS (SELECT CustomerId, {", ".join(f"CASE WHEN {k} > -1 THEN ln(1 + {k}) END AS {k}" for k in kept.values())} FROM raw),
norm AS (SELECT CustomerId, {", ".join(f'round(({k} - (SELECT avg({k}) FROM logs)) / (SELECT stddev_pop({k}) FROM logs) + 1e-9, 4) + 0.0 AS "{n}_log_std"' for n, k in kept.items())} FROM logs)"""


def _woe_columns_sql(cats: tuple[str, ...]) -> str:
    picks = ", ".join(f'round(coalesce(max(CASE WHEN l.feature = {chr(39)}{n}{chr(39)} THEN woe END), 0) + 1e-9, 4) + 0.0 AS "{n}_woe"' for n in cats)
    long = " UNION ALL ".join(f"SELECT CustomerId, '{n}' AS feature, coalesce({n}, '__NA__') AS bin FROM m" for n in cats)
    return f"enc AS (SELECT CustomerId, {picks} FROM ({long}) l LEFT JOIN w ON l.feature = w.feature AND l.bin = w.bin GROUP BY CustomerId)"


# kept by the pruning and the information value filter on the check data
_BASIC_NORM = {"Amount_sum": "s", "Amount_mean": "m", "Amount_max": "x", "Amount_skew": "k"}
_NORM = {**_BASIC_NORM, "Recent30_Amount_sum": "rs", "Recent30_TransactionStartTime_count": "rc"}
_LINE_NORM = {**_BASIC_NORM, "Value_max": "vx", "Recent30_Amount_sum": "rs", "Recent30_Amount_mean": "rm", "Recent30_TransactionStartTime_count": "rc"}
_HOT_SQL = ", ".join(f'CAST({n} = {chr(39)}{v}{chr(39)} AS BIGINT) AS "{n}_{v}"'
                     for n, vs in (("ProductCategory", _PRIORITIES), ("ChannelId", _STATUS), ("ProviderId", _SEGMENTS)) for v in vs)
_JOINED = "SELECT * EXCLUDE (HasFraud) FROM agg JOIN modes USING (CustomerId) JOIN gaps USING (CustomerId) JOIN velocity USING (CustomerId) JOIN hot USING (CustomerId) JOIN norm USING (CustomerId) JOIN enc USING (CustomerId)"


@query(f"""WITH {_LABELED}, {_WOE}, agg AS ({_AGG_SQL}), {_GAPS}, {_VELOCITY}, modes AS ({_MODES}), hot AS (SELECT CustomerId, {_HOT_SQL} FROM m),
{_norm_sql(_NORM)}, {_woe_columns_sql(("ProductCategory", "ProviderId"))} {_JOINED}""")
def feature_table(spark, sf_dir):
    """The complete customer feature table: aggregates, time features, one-hot, scaled and WoE columns."""
    table = build_features(txn_orders(spark, sf_dir, with_segment=True), FeatureConfig(categories=_CATS, stage_input=True))[0]
    return rounded(table, **_SUMS, **_SIX)


_LINE_HOT = ", ".join(f"CAST(ChannelId = '{v}' AS BIGINT) AS \"ChannelId_{v}\"" for v in ("A", "N", "R"))


@query(f"""WITH {_labeled_sql(TXN_LINES, ("ProductCategory", "ChannelId"))}, {_WOE}, agg AS ({_AGG_SQL}), {_GAPS}, {_VELOCITY}, modes AS ({_MODES}),
hot AS (SELECT CustomerId, {_LINE_HOT}, round((count(*) OVER (PARTITION BY ProductCategory)) / (count(*) OVER ()) + 1e-9, 4) + 0.0 AS "ProductCategory_freq" FROM m),
{_norm_sql(_LINE_NORM)}, {_woe_columns_sql(("ProductCategory", "ChannelId"))} {_JOINED}""")
def feature_table_lines(spark, sf_dir):
    """The complete feature table of the line transactions, with a frequency-encoded brand."""
    table = build_features(txn_lines(spark, sf_dir), FeatureConfig(categories=("ProductCategory", "ChannelId"), stage_input=True))[0]
    return rounded(table, **_SUMS, **_SIX)


_BASIC_COLUMNS = ", ".join(f'agg."{n}"' for n in (
    "CustomerId", *[f"{m}_{k}" for m in ("Amount", "Value") for k in ("sum", "mean", "max", "std", "skew")], "TransactionStartTime_count",
    "TransactionStartTime_period", "Hour_mean", "Hour_std", "Weekday_mean", "Weekday_std", "Day_mean", "Month_mean", "Year_mean", "IsWeekend_mean"))


@query(f"""WITH {TXN_ORDERS_SEGMENT}, m AS ({_modal_sql(_CATS)}),
b AS ({" UNION ALL ".join(f"SELECT '{n}' AS feature, coalesce({n}, '__NA__') AS bin, FraudResult AS HasFraud FROM txn" for n in _CATS)}), {_WOE},
agg AS ({_AGG_SQL}), modes AS ({_MODES}), hot AS (SELECT CustomerId, {_HOT_SQL} FROM m), {_norm_sql(_BASIC_NORM)}, {_woe_columns_sql(_CATS)}
SELECT {_BASIC_COLUMNS}, modes.* EXCLUDE (CustomerId), hot.* EXCLUDE (CustomerId), norm.* EXCLUDE (CustomerId), enc.* EXCLUDE (CustomerId)
FROM agg JOIN modes ON agg.CustomerId = modes.CustomerId JOIN hot ON agg.CustomerId = hot.CustomerId JOIN norm ON agg.CustomerId = norm.CustomerId JOIN enc ON agg.CustomerId = enc.CustomerId""")
def feature_table_basic(spark, sf_dir):
    """The earlier, smaller feature set with WoE fitted on transactions."""
    return rounded(build_features(txn_orders(spark, sf_dir, with_segment=True), replace(BASIC, stage_input=True))[0], **_SUMS)


_DESCRIBED = """SELECT feature AS Feature, 'Weight of Evidence encoding for ' || replace(feature, '_woe', '') AS Description,
  'WoE coding (quantile binning)' AS Transformation, printf('%.4f', iv) AS IV_Value FROM iv"""


_NUMERIC_NAMES = ([f"{m}_{k}" for m in ("Amount", "Value") for k in ("sum", "mean", "max", "std", "skew")] + ["TransactionStartTime_count", "TransactionStartTime_period"]
                  + [f"Recent30_{m}_{k}" for m in ("Amount", "Value") for k in ("sum", "mean")] + ["Recent30_TransactionStartTime_count"]
                  + [f"{p}_{k}" for p in ("Hour", "Weekday") for k in ("mean", "std")] + [f"{p}_{k}" for p in ("Day", "Month", "Year") for k in ("mean", "mode")]
                  + ["IsWeekend_mean", "IsBusinessHours_mean"] + [f"{p}_{k}_mean" for p in ("Hour", "Month") for k in ("sin", "cos")]
                  + [f"TimeSinceLast_{k}" for k in ("mean", "min", "max")] + [f"Velocity_{w}d_mean" for w in (1, 7, 30)])


def _describe_sql(test_to_text: list[tuple[str, str, str]], column: int) -> str:
    return "CASE " + " ".join(f"WHEN {t[0]} THEN {t[column]}" for t in test_to_text) + (" ELSE 'Generated feature' END" if column == 1 else " ELSE 'See transformation details' END")


_TEXTS = [
    ("f LIKE '%_log_std'", "'Log-transformed and standardized ' || replace(f, '_log_std', '')", "'log1p + StandardScaler'"),
    ("f LIKE 'Recent30%'", "'Recent 30-day activity: ' || f", "'Windowed aggregation'"),
    ("f LIKE 'Velocity%'", "'Transaction velocity (average per ' || split_part(replace(f, 'd_mean', ''), '_', 2) || ' days)'", "'Rolling window calculation'"),
    ("f LIKE 'TimeSinceLast%'", "'Recency metric: ' || split_part(f, '_', 2) || ' days since last transaction'", "'Time difference aggregation'"),
    ("f LIKE '%/_sin/_%' ESCAPE '/' OR f LIKE '%/_cos/_%' ESCAPE '/'", "'Cyclical encoding for temporal patterns'", "'sin/cos transformation'"),
    ("f LIKE 'Is%'", "'Fraction of transactions (' || replace(f, '_mean', '') || ')'", "'Boolean aggregation'"),
    ("f LIKE 'Hour%' OR f LIKE 'Weekday%'", "'Temporal aggregation'", "'Extracted from timestamp, aggregated'"),
    ("f LIKE 'Day%' OR f LIKE 'Month%' OR f LIKE 'Year%'", "'Calendar component aggregation'", "'Extracted from timestamp, aggregated'"),
    ("f LIKE '%sum'", "'Sum of values'", "'Customer aggregation'"),
    ("f LIKE '%mean'", "'Mean value'", "'Customer aggregation'"),
    ("f LIKE '%skew'", "'Skewness of values'", "'Customer aggregation'"),
]


@query(f"""WITH {_LABELED}, {_WOE}, iv AS (SELECT feature || '_woe' AS feature, sum(iv) AS iv FROM w GROUP BY feature HAVING sum(iv) >= 0.02),
hot AS (SELECT DISTINCT feature || '_' || bin AS f FROM b), names(f) AS (VALUES {", ".join(f"('{n}')" for n in [*_NUMERIC_NAMES, *[f"{n}_log_std" for n in _NORM]])})
{_DESCRIBED} UNION ALL SELECT f, 'One-hot encoding for ' || f, 'One-hot encoding', '' FROM hot
UNION ALL SELECT f, {_describe_sql(_TEXTS, 1)}, {_describe_sql(_TEXTS, 2)}, '' FROM names""")
def feature_dictionary(spark, sf_dir):
    """Description, transformation and IV of every feature."""
    return build_features(txn_orders(spark, sf_dir, with_segment=True), FeatureConfig(categories=_CATS, stage_input=True))[1]
