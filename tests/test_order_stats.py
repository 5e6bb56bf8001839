"""Exact order statistics against sorting, on both the one-pass and the counting path."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions.order_stats import dense_codes, exact_quantiles, order_statistics, running_totals, split_index, with_codes
from riskloom.functions.joins import freeze, hot_keys, skew_safe_join
from riskloom.operators.correlation import correlations


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 101 == 0, float("nan")).otherwise(F.sin("id") * 1e6).alias("x"),
        F.md5(F.col("id").cast("string")).alias("s"))
    return df.persist()


@pytest.mark.parametrize("one_pass", [10**9, 0])
def test_quantiles_equal_numpy(table, one_pass):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(table, ["x"], probs, one_pass)["x"]
    x = table.select("x").toPandas()["x"].dropna()
    assert got == pytest.approx(list(np.quantile(x, probs)), rel=1e-12)


def test_ranks_need_no_large_collect(table):
    ranks = [1, 2, 6_000, 9_999, 19_801]
    x = np.sort(table.select("x").toPandas()["x"].dropna())
    ranks = [r for r in ranks if r <= len(x)]
    got = order_statistics(table, {"x": ranks}, collect_limit=20)["x"]
    assert [got[r] for r in ranks] == [x[r - 1] for r in ranks]


def test_text_ranks(table):
    s = sorted(table.select("s").toPandas()["s"])
    got = order_statistics(table, {"s": [1, 777, 20_000]}, collect_limit=50)["s"]
    assert got == {1: s[0], 777: s[776], 20_000: s[-1]}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40), st.data())
def test_any_rank_of_tied_values(spark, values, data):
    rank = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert order_statistics(df, {"v": [rank]}, collect_limit=2)["v"][rank] == sorted(values)[rank - 1]


def test_rank_out_of_range(table):
    with pytest.raises(ValueError):
        order_statistics(table, {"x": [0]})


@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals_across_parts(table, ascending):
    counts = table.where(~F.isnan("x")).groupBy("x").agg(F.count("*").alias("n"))
    got = running_totals(counts, "x", {"upto": "n"}, ascending, rows_per_split=700).toPandas().sort_values("x", ascending=ascending)
    assert (got["n"].cumsum().values == got["upto"].values).all()


def test_codes_are_sorted_positions(table, spark):
    codes = dense_codes(table, "s", rows_per_split=500).toPandas().sort_values("value")
    assert codes["code"].tolist() == list(range(20_000))
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    got = with_codes(df, "v", "code", dense_codes(df, "v")).collect()
    assert sorted((r["v"] or "", r["code"]) for r in got) == [("", -1), ("a", 0), ("b", 1), ("b", 1)]


def test_split_index_counts_points_at_or_below(spark):
    points = [float(p) for p in range(0, 40, 3)]
    df = spark.range(-2, 45).select(F.col("id").cast("double").alias("v"))
    for r in df.select("v", split_index(F.col("v"), points).alias("i")).collect():
        assert r["i"] == sum(p <= r["v"] for p in points)


def test_freeze_keeps_large_tables_distributed(spark):
    small, large = freeze(spark.range(5), "t").df, freeze(spark.range(100), "t", max_rows=10).df
    assert small.count() == 5 and large.count() == 100
    assert "LocalTableScan" in small._jdf.queryExecution().toString()
    assert "parquet" in large._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_join_keeps_every_row(spark, how):
    left = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 1_000 == 1, None).otherwise(F.col("id") % 900).alias("k"))
    right = spark.range(0, 800).select(F.col("id").alias("r"), (F.col("id") * 10).alias("v"))
    assert hot_keys(left, "k") == [7]
    got = skew_safe_join(left, right, "k", "r", how, broadcast_rows=10)
    want = left.join(right, F.col("k") == F.col("r"), how)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    plan = got._jdf.queryExecution().toString()
    assert "__salt" in plan


@pytest.mark.parametrize("limit", [60, 0])
def test_pairwise_complete_correlation(spark, monkeypatch, limit):
    monkeypatch.setattr("riskloom.operators.correlation.AGGREGATED_PRODUCTS", limit)
    rng = np.random.default_rng(3)
    x = rng.normal(size=500) + 2_000
    y = 3 * x + rng.normal(size=500)
    z = rng.exponential(size=500)
    rows = [(float(a), None if i % 4 == 0 else float(b), float("nan") if i % 7 == 0 else float(d), 1.0, None) for i, (a, b, d) in enumerate(zip(x, y, z))]
    df = spark.createDataFrame(rows, "x double, y double, z double, k double, e double")
    want = df.toPandas().astype(float).corr()
    for (a, b), r in correlations(df, df.columns).items():
        if a == b:
            continue
        assert (r is None) if np.isnan(want.loc[a, b]) else r == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)
