"""Customer features on the four-row fixture and on awkward inputs."""

import math

import pytest
from conftest import SMOKE_SCHEMA, by_key
from pyspark.sql import functions as F

from riskloom.operators.aggregate import customer_aggregates, modal_categories
from riskloom.operators.encode import CategoryEncoder
from riskloom.operators.normalize import pruned_columns
from riskloom.operators.temporal import days_since_previous, temporal_features, velocity
from riskloom.operators.woe import Woe
from riskloom.plans.features import BASIC, FeatureConfig, fit_features
from riskloom.sources.transactions import SyntheticShape, synthetic_transactions

GOLDEN = {
    "C1": {
        "Amount_sum": 150, "Amount_mean": 75, "Amount_max": 100, "Amount_std": 35.355339, "Value_sum": 15, "Value_mean": 7.5, "Value_std": 3.535534,
        "Amount_skew": None, "Value_skew": None, "TransactionStartTime_count": 2, "TransactionStartTime_period": 2,
        "Recent30_Amount_sum": 150, "Recent30_TransactionStartTime_count": 2, "Hour_mean": 12.5, "Hour_std": 0.707107, "Weekday_mean": 2.5,
        "Weekday_std": 0.707107, "Day_mean": 1.5, "Day_mode": 1, "Month_mean": 1, "Month_mode": 1, "Year_mean": 2025, "Year_mode": 2025,
        "IsWeekend_mean": 0, "IsBusinessHours_mean": 1, "Hour_sin_mean": -0.129410, "Hour_cos_mean": -0.982963, "Month_sin_mean": 0.5,
        "Month_cos_mean": 0.866025, "TimeSinceLast_mean": 1.041667, "TimeSinceLast_min": 1.041667, "TimeSinceLast_max": 1.041667,
        "Velocity_1d_mean": 1, "Velocity_7d_mean": 1, "Velocity_30d_mean": 1, "ProductCategory_A": 1, "ProductCategory_B": 0,
        "ChannelId_app": 1, "ChannelId_web": 0, "ProductCategory_woe": 0.693147, "ChannelId_woe": 0.693147, "Amount_sum_log_std": -1},
    "C2": {
        "Amount_sum": 350, "Amount_mean": 175, "Amount_max": 200, "Amount_std": 35.355339, "Value_sum": 35, "Value_mean": 17.5,
        "TransactionStartTime_count": 2, "TransactionStartTime_period": 3, "Recent30_Amount_sum": 350, "Hour_mean": 12, "Hour_std": 2.828427,
        "Weekday_mean": 3, "Weekday_std": 1.414214, "Day_mean": 2, "Day_mode": 1, "Hour_sin_mean": 0, "Hour_cos_mean": -0.866025,
        "TimeSinceLast_mean": 2.166667, "TimeSinceLast_min": 2.166667, "TimeSinceLast_max": 2.166667, "ProductCategory_A": 0, "ProductCategory_B": 1,
        "ChannelId_app": 0, "ChannelId_web": 1, "ProductCategory_woe": -0.693147, "ChannelId_woe": -0.693147, "Amount_sum_log_std": 1},
}


@pytest.fixture(scope="module")
def model(smoke):
    return fit_features(smoke, FeatureConfig(categories=("ProductCategory", "ChannelId")))


def test_smoke_goldens(model):
    rows = by_key(model.features_of(model.base))
    for key, want in GOLDEN.items():
        for name, value in want.items():
            got = rows[key][name]
            assert (got is None) if value is None else got == pytest.approx(value, abs=2e-6), (key, name, got)


def test_smoke_information_value_and_pruning(model):
    assert model.woe.ivs == pytest.approx({"ProductCategory": 0.462098, "ChannelId": 0.462098}, abs=1e-6)
    assert model.normalizer.feature_names == ["Amount_sum_log_std", "Amount_skew_log_std", "Value_skew_log_std", "Recent30_TransactionStartTime_count_log_std"]
    rows = by_key(model.features_of(model.base))
    assert rows["C1"]["Recent30_TransactionStartTime_count_log_std"] == 0


def test_dictionary_covers_every_feature(model):
    features = model.features_of(model.base)
    rows = by_key(model.dictionary(), "Feature")
    assert set(rows) == set(features.columns) - {"CustomerId"}
    assert rows["ProductCategory_woe"]["IV_Value"] == "0.4621"
    assert rows["Amount_sum_log_std"]["Description"] == "Log-transformed and standardized Amount_sum"
    assert rows["Velocity_7d_mean"]["Description"] == "Transaction velocity (average per 7 days)"
    assert rows["Hour_sin_mean"]["Transformation"] == "sin/cos transformation"


def test_frozen_model_applies_to_later_transactions(spark, model):
    later = spark.createDataFrame([("C9", 200.0, 20.0, "2025-02-01 10:00:00", "Z", None, None)], SMOKE_SCHEMA).selectExpr(
        "CustomerId", "Amount", "Value", "cast(t as timestamp) as TransactionStartTime", "ProductCategory", "ChannelId", "FraudResult")
    out = model.transform(later)
    assert out.columns == model.features_of(model.base).columns
    row = by_key(out)["C9"]
    assert row["ProductCategory_A"] == row["ProductCategory_B"] == 0 and row["ProductCategory_woe"] == 0
    assert row["Amount_std"] is None and row["TimeSinceLast_mean"] is None
    mean, std = (math.log1p(150) + math.log1p(350)) / 2, (math.log1p(350) - math.log1p(150)) / 2
    assert row["Amount_sum_log_std"] == pytest.approx((math.log1p(200) - mean) / std)


def test_basic_variant(smoke):
    model = fit_features(smoke.limit(3), BASIC)
    cols = model.features_of(model.base).columns
    assert not [n for n in cols if n.startswith(("Recent30", "Velocity", "TimeSinceLast")) or "_sin" in n]
    assert "ProductCategory_woe" in cols and "Day_mode" in cols


def test_inactive_customer_keeps_nulls(spark):
    txn = spark.createDataFrame([("A", 1.0, 1.0, "2025-01-01 00:00:00"), ("B", 2.0, 2.0, "2025-03-01 00:00:00"), (None, 9.0, 9.0, "2025-03-02 00:00:00")],
                                "CustomerId string, Amount double, Value double, t string").selectExpr("CustomerId", "Amount", "Value", "cast(t as timestamp) as TransactionStartTime")
    rows = by_key(customer_aggregates(txn, calendar=False))
    assert set(rows) == {"A", "B"}
    assert rows["A"]["Recent30_Amount_sum"] is None and rows["A"]["Recent30_TransactionStartTime_count"] is None
    assert rows["B"]["Recent30_Amount_sum"] == 2.0


def test_skew_edges(spark):
    data = [("n2", float(x)) for x in (1, 5)] + [("const", 3.0)] * 4 + [("g1", float(x)) for x in (1, 2, 2, 7)] + [("nan", x) for x in (1.0, float("nan"), 2.0, 2.0, 7.0)]
    txn = spark.createDataFrame(data, "CustomerId string, Amount double").selectExpr("CustomerId", "Amount", "Amount as Value", "timestamp'2025-01-01' as TransactionStartTime")
    rows = by_key(customer_aggregates(txn, calendar=False, recent=False))
    assert rows["n2"]["Amount_skew"] is None and rows["const"]["Amount_skew"] == 0.0
    assert rows["g1"]["Amount_skew"] == pytest.approx(1.8128, abs=1e-4) == rows["nan"]["Amount_skew"]


def test_period_counts_elapsed_days_not_midnights(spark):
    txn = spark.sql("select * from values ('A', timestamp'2025-01-01 23:00:00'), ('A', timestamp'2025-01-02 01:00:00') as t(CustomerId, TransactionStartTime)")
    txn = txn.selectExpr("*", "1D as Amount", "1D as Value")
    assert by_key(customer_aggregates(txn, recent=False))["A"]["TransactionStartTime_period"] == 1


def test_rows_without_a_time(spark):
    txn = spark.sql("select * from values ('A', timestamp'2025-01-04 10:00:00'), ('A', null), ('B', null) as t(CustomerId, TransactionStartTime)")
    rows = by_key(customer_aggregates(txn.selectExpr("*", "1D as Amount", "1D as Value")))
    assert rows["A"]["IsWeekend_mean"] == 0.5 and rows["A"]["Hour_mean"] == 10 and rows["A"]["Hour_std"] is None
    assert rows["B"]["Hour_mean"] is None and rows["B"]["Hour_std"] is None and rows["B"]["IsBusinessHours_mean"] == 0 and rows["B"]["TransactionStartTime_period"] is None


def brute_force(pdf):
    """Gaps, velocities and modes by sorting each customer in pandas."""
    out = {}
    for key, g in pdf.groupby("CustomerId"):
        ts = g["ts"].sort_values()
        gaps = ts.diff().dt.total_seconds() / 86400
        counts = ts.dt.date.value_counts().sort_index()
        row = {"TimeSinceLast_mean": gaps.mean(), "TimeSinceLast_min": gaps.min(), "TimeSinceLast_max": gaps.max()}
        row |= {f"Velocity_{w}d_mean": counts.rolling(w, min_periods=1).mean().mean() for w in (1, 7, 30)}
        row |= {"Day_mode": ts.dt.day.mode().iloc[0], "Month_mode": ts.dt.month.mode().iloc[0], "Year_mode": ts.dt.year.mode().iloc[0]}
        out[key] = row
    return out


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows belong to one customer, with bursts and repeated instants."""
    base = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400).alias("CustomerId"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.when(F.col("id") % 5 == 0, (F.col("id") % 50) * 3_600_000_000)
                           .otherwise(F.pmod(F.xxhash64("id"), F.lit(40_000_000)) * 100_000)).alias("ts"))
    return base


def test_temporal_features_match_brute_force_with_a_hot_customer(hot):
    txn = hot.withColumnRenamed("ts", "TransactionStartTime")
    got, want = by_key(temporal_features(txn)), brute_force(hot.toPandas())
    assert set(got) == set(want)
    for key, row in want.items():
        for name, value in row.items():
            if value != value:
                assert got[key][name] is None
            else:
                assert got[key][name] == pytest.approx(value, abs=1e-9), (key, name)


def test_days_since_previous_matches_brute_force(hot):
    pdf = hot.toPandas().sort_values(["CustomerId", "ts"])
    want = (pdf.groupby("CustomerId")["ts"].diff().dt.total_seconds() / 86400).fillna(-1).round(9)
    got = days_since_previous(hot.withColumnRenamed("ts", "TransactionStartTime")).toPandas()["TimeSinceLast"].fillna(-1).round(9)
    assert sorted(got) == pytest.approx(sorted(want))


def test_calendar_velocity_differs_from_active_days(spark):
    txn = spark.sql("select 'A' CustomerId, timestamp'2025-01-01' TransactionStartTime union all select 'A', timestamp'2025-01-20'")
    assert by_key(velocity(txn))["A"]["Velocity_7d_mean"] == 1
    assert by_key(velocity(txn, calendar=True))["A"]["Velocity_7d_mean"] == pytest.approx(1 / 7)


def test_modal_category_ties_and_nulls(spark):
    txn = spark.createDataFrame([("A", "y", None), ("A", "x", None), ("A", None, None), ("B", "z", "k")], "CustomerId string, p string, q string")
    rows = by_key(modal_categories(txn, ["p", "q"]))
    assert rows["A"]["p"] == "x" and rows["A"]["q"] is None and rows["B"]["q"] == "k"


def test_encoder_routes_by_cardinality_and_keeps_null_bucket(spark):
    df = spark.createDataFrame([(i, f"v{i % 12}", "a" if i % 2 else None) for i in range(48)], "CustomerId int, many string, few string")
    model = CategoryEncoder(["many", "few"]).fit(df)
    assert model.feature_names == ["few___NA__", "few_a", "many_freq"]
    other = spark.createDataFrame([(1, "v3", None), (2, "new", "b")], "CustomerId int, many string, few string")
    rows = by_key(model.transform(other, ["CustomerId"]))
    assert rows[1]["many_freq"] == pytest.approx(1 / 12) and rows[1]["few___NA__"] == 1
    assert rows[2]["many_freq"] == 0 and rows[2]["few_a"] == rows[2]["few___NA__"] == 0


def test_pruning_counts_dropped_columns_too():
    pairs = {("a", "a"): 1.0, ("a", "b"): 0.99, ("a", "c"): 0.5, ("b", "c"): -0.97, ("a", "d"): None}
    assert pruned_columns(pairs, ["a", "b", "c", "d"]) == ["a", "d"]


def test_woe_guards(spark):
    df = spark.createDataFrame([("x", 0), ("y", 0)], "f string, y int")
    with pytest.raises(ValueError):
        Woe(["f"], "absent").fit(df)
    assert Woe(["f"], "y").fit(df) is None


def test_woe_numeric_bins_follow_first_ranks(spark):
    values = [(i, float(v), i % 2) for i, v in enumerate([5, 5, 5, 5, 1, 9, 9, 2, 3, 5])]
    df = spark.createDataFrame(values, "k int, x double, y int")
    model = Woe(["x"], "y", 4, "k").fit(df)
    bins = df.select("k", "x", model.bin_exprs(df.schema)["x"].alias("b")).toPandas().sort_values(["x", "k"])
    want = [max(1, math.ceil((r - 1) * 4 / 9)) for r in range(1, 11)]
    assert bins["b"].tolist() == want


def test_synthetic_transactions(spark):
    txn = synthetic_transactions(spark, 2_000, customers=100, shape=SyntheticShape(label_share=0.1))
    row = txn.agg(F.count("*").alias("n"), F.count_distinct("CustomerId").alias("c"), F.min("Amount").alias("lo"), F.avg("FraudResult").alias("y"),
                  F.count_distinct("ProviderId").alias("p")).first()
    assert row["n"] == 2_000 and row["c"] == 100 and row["lo"] > 0 and row["p"] == 4 and 0.07 < row["y"] < 0.13


def test_modes_of_lines_join_once(spark, tmp_path, monkeypatch):
    """The lines' join with orders and parts is made once, whatever the number of passes over the categories."""
    from riskloom.catalog import QUERIES
    from riskloom.functions import joins

    d = str(tmp_path)
    spark.range(400).selectExpr("id % 90 AS l_orderkey", "id % 7 AS l_partkey", "id % 70 AS l_suppkey", "1.0D AS l_extendedprice", "0.0D AS l_discount", "'A' AS l_returnflag").write.parquet(f"{d}/lineitem.parquet")
    spark.range(90).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "DATE'2020-01-01' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "concat('b', id) AS p_brand").write.parquet(f"{d}/part.parquet")
    measured = []
    plain = joins.hot_keys
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, *a: False)
    monkeypatch.setattr(joins, "hot_keys", lambda df, key: measured.append(df._jdf.queryExecution().optimizedPlan().toString()) or plain(df, key))
    got = QUERIES["modal_categories_many_values"](spark, d)
    assert got.count() == 9 and len(measured) >= 2 and not any("Join" in plan for plan in measured)
    assert "orders.parquet" not in got._jdf.queryExecution().optimizedPlan().toString() and not any("orders.parquet" in f for f in got.inputFiles())
