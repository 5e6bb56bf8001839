"""Cleaning, splitting, profiling and table sources."""

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from riskloom.operators import clean as C
from riskloom.operators import profile as P
from riskloom.operators.split import model_split, random_split, stratified_folds, stratified_split
from riskloom.sources.tables import (numeric_features, parse_requests, read_requests, read_table, requests_from_wide, write_features, write_labels,
                                     write_split, write_table)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [("k1", "NA", "2024-01-05", 1.0, None), ("k2", "x", "bad", None, None), ("k2", "x", "bad", None, None), ("k3", "", "2024-02-01", 4.0, None),
            ("k4", "Unknown", None, 2.0, "only"), ("k5", "y", "2024-01-01", float("nan"), None), ("k6", "None", "2024-01-01", 7.0, None)]
    return spark.createDataFrame(rows, "k string, c string, d string, n double, s string")


def test_clean_sequence(raw):
    cfg = C.CleanConfig(date_columns=("d",), one_hot_max_unique=3, target=lambda df: (F.col("n") > 3).cast("int"))
    out = C.clean(raw, cfg)
    rows = {r["k_code"]: r.asDict() for r in out.collect()}
    assert "s" not in out.columns and "c" not in out.columns and len(rows) == 6
    assert {"c_Missing", "c_x", "c_y"} <= set(out.columns)
    assert rows[0]["d"].year == 2024 and rows[1]["d"] is None
    assert rows[1]["n"] == rows[4]["n"] == 3.0  # median of 1, 2, 4, 7
    assert [rows[i]["c_Missing"] for i in range(6)] == [1, 0, 1, 1, 0, 1]
    assert rows[5]["target"] == 1


def test_null_share_limit_is_strict(spark):
    df = spark.createDataFrame([(i, None if i < 8 else 1) for i in range(10)], "a int, b int")
    assert C.sparse_columns(df, 0.8) == [] and C.sparse_columns(df, 0.79) == ["b"]


def test_unprocessed_table_cannot_be_saved():
    with pytest.raises(ValueError):
        write_table(None, "/tmp/never.parquet")


def test_unknown_extension_is_an_error(spark):
    with pytest.raises(ValueError):
        read_table(spark, "/tmp/data.xyz")


def test_sinks(spark, smoke, tmp_path):
    features, dictionary = write_features(smoke, spark.createDataFrame([("a", "b")], "Feature string, Description string"), str(tmp_path / "f"))
    assert spark.read.parquet(features).count() == 4 and read_table(spark, dictionary).first()["Feature"] == "a"
    labels = smoke.select("CustomerId", F.col("FraudResult").alias("is_high_risk"))
    one, two = write_labels(labels, smoke, str(tmp_path / "l"))
    assert spark.read.parquet(one).columns == ["CustomerId", "is_high_risk"] and spark.read.parquet(two).count() == 4
    train, test = write_split(smoke.withColumn("split", F.when(F.col("Amount") > 180, "test").otherwise("train")), str(tmp_path / "s"))
    assert spark.read.parquet(train).count() == 3 and spark.read.parquet(test).count() == 1


@pytest.fixture(scope="module")
def labeled(spark):
    """One class holds nine tenths of the rows, another has two."""
    return spark.range(5_002).select("id", F.when(F.col("id") >= 5_000, "rare").when(F.col("id") % 10 == 0, "b").otherwise("a").alias("y"))


def test_stratified_split_sizes(labeled):
    out = stratified_split(labeled, "y", ["id"], 0.2, 42)
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {("a", "test"): 900, ("a", "train"): 3_600, ("b", "test"): 100, ("b", "train"): 400, ("rare", "test"): 1, ("rare", "train"): 1}
    again = stratified_split(labeled, "y", ["id"], 0.2, 42)
    assert out.exceptAll(again).count() == 0
    assert out.exceptAll(stratified_split(labeled, "y", ["id"], 0.2, 7)).count() > 0


def test_random_split_size(labeled):
    assert random_split(labeled, ["id"], 0.2).where("split = 'test'").count() == 1_000  # 1000.4
    assert random_split(labeled, ["id"], 0.0).where("split = 'test'").count() == 0


def test_model_split_keeps_shares(labeled):
    train, test = model_split(labeled.where("y <> 'rare'").withColumn("y", (F.col("y") == "b").cast("int")), "y", ["id"])
    assert abs(train.agg(F.avg("y")).first()[0] - test.agg(F.avg("y")).first()[0]) < 0.02
    assert train.count() + test.count() == 5_000


def test_folds_are_balanced(labeled):
    out = stratified_folds(labeled, "y", ["id"], 5)
    sizes = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert {sizes["a", k] for k in range(5)} == {900} and {sizes["b", k] for k in range(5)} == {100}
    assert sum(v for (y, _), v in sizes.items() if y == "rare") == 2


def test_missing_table_advice(spark):
    rows = [(i, None if i < 4 else 1.0, None if i < 25 else "v", None if i < 60 else "w", None if i < 40 else 2.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, few double, some string, most string, half double")
    got = by_key(P.missing_table(df), "column")
    assert {k: r["Suggestion"] for k, r in got.items()} == {"few": "median", "some": "mode_with_flag", "most": "consider_drop_or_new_category", "half": "consider_drop_or_model"}
    assert got["few"]["Percent"] == 4.0 and got["some"]["Sample"] == ["v"] and got["some"]["Nunique"] == 1
    assert [r["column"] for r in P.missing_table(df).collect()] == ["most", "half", "some", "few"]
    assert got["few"]["Suggestion_Explanation"] == "Impute numeric values with median"


def test_empty_table_reports(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert P.missing_table(df).count() == 0
    assert P.describe(df, ["a"]).first()["count"] == 0
    assert P.histogram(df, ["a"]).count() == 0


def test_constant_column_profiles(spark):
    df = spark.createDataFrame([(3.0,)] * 10, "a double")
    assert P.zscore_outliers(df, k=None).first()["OutlierCount"] == 0
    assert P.boxplot_stats(df).first()["outliers"] == 0
    assert sum(r["n"] for r in P.histogram(df, ["a"], 5).collect()) == 10


def test_category_counts_gate(spark):
    df = spark.createDataFrame([(f"v{i}", "c") for i in range(20)], "many string, few string")
    assert {r["feature"] for r in P.category_counts(df).collect()} == {"few"}


def test_request_parsing(spark, tmp_path):
    lines = ['{"customer_id": "A", "features": {"x": 1, "y": "2024"}}', '{"features": {"x": null, "y": 2}}', '{"customer_id": "C", "features": {"x": "oops", "y": 1}}',
             '{"customer_id": "D", // comment', '{"customer_id": "E", "features": {}}']
    path = str(tmp_path / "r.json")
    with open(path, "w") as f:
        f.write("\n".join(lines))
    rows = numeric_features(read_requests(spark, path)).collect()
    by = {r["customer_id"]: r for r in rows if r["_corrupt_record"] is None}
    assert by["A"]["features"] == {"x": 1.0, "y": 2024.0} and by[None]["features"]["x"] is None
    assert by["C"]["features"] == {"x": None, "y": 1.0} and by["E"]["features"] == {}
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1
    text = spark.createDataFrame([(x,) for x in lines], "value string")
    assert parse_requests(text).where("_corrupt_record is not null").count() == 1


def test_wide_requests_number_rows_in_order(spark, tmp_path):
    path = write_table(spark.range(0, 50, numPartitions=1).selectExpr("id as a", "if(id = 3, null, id * 2) as b"), str(tmp_path / "w.csv"))
    rows = requests_from_wide(read_table(spark, path)).collect()
    got = {r["customer_id"]: r["features"] for r in rows}
    assert got["CUST_0001"] == {"a": 0.0, "b": 0.0} and got["CUST_0004"] == {"a": 3.0} and got["CUST_0050"]["a"] == 49.0
