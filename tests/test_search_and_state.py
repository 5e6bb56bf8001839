"""Model search, compiled models, k-means, radix splits, packed maps, hot keys and the run log."""

import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.functions import joins, packed
from riskloom.functions.joins import Lookup, freeze, hot_keys, row_salt, skew_safe_join
from riskloom.functions.packed import PackedMaps
from riskloom.operators import kmeans
from riskloom.operators import metrics as M
from riskloom.operators import woe as W
from riskloom.operators.aggregate import modal_categories
from riskloom.operators.split import stratified_folds, stratified_split
from riskloom.plans import compiled
from riskloom.plans import training as T
from riskloom.session import materialize
from riskloom.sources import runlog
from riskloom.sources.artifacts import load_model, save_model


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        F.col("id").alias("CustomerId"), F.when(F.col("id") % 9 != 0, F.randn(1)).alias("x"), F.randn(2).alias("noise"),
        F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").otherwise("it's").alias("cat"))
    df = df.withColumn("is_high_risk", ((F.coalesce("x", F.lit(0.0)) + F.when(F.col("cat") == "a", 1.0).otherwise(0.0) + 0.3 * F.randn(3)) > 0.4).cast("int"))
    return materialize(df, "search")


@pytest.mark.parametrize("name, values, nested", [
    ("logistic", {"C": 1}, 0), ("random_forest", {"trees": 12, "depth": 5}, 0), ("random_forest", {"trees": 3, "depth": 2}, 10_000),
    ("gradient_boosting", {"rate": 0.1, "trees": 6}, 0), ("gradient_boosting", {"rate": 0.1, "trees": 6}, 10_000)])
def test_compiled_models_score_as_the_pipeline(spark, table, tmp_path, monkeypatch, name, values, nested):
    monkeypatch.setattr(compiled, "NESTED_NODES", nested)
    weighted, n = T.with_balanced_weights(table, "is_high_risk")
    est = T._classifier(name, "is_high_risk")
    model = Pipeline(stages=[*T.prep_stages(["x", "noise"], ["cat"]), est.copy(T._settings(name, est, values, n))]).fit(weighted)
    path = save_model(spark, model, ["x", "noise", "cat"], str(tmp_path / "m"), name)
    scorer = load_model(spark, path).compiled(spark)
    odd = spark.createDataFrame([(9_000, None, None, None), (9_001, float("nan"), 1.0, "new")], "CustomerId long, x double, noise double, cat string")
    rows = table.drop("is_high_risk").unionByName(odd)
    both = scorer.apply(model.transform(rows).select(*rows.columns, vector_to_array("probability")[1].alias("want")))
    worst = both.agg(F.max(F.abs(F.col("__p") - F.col("want"))), F.count("__p")).first()
    assert worst[0] < 1e-12 and worst[1] == 402
    assert "UDF" not in scorer.apply(rows)._jdf.queryExecution().executedPlan().toString()


def test_first_trees_are_the_smaller_ensemble(spark, table):
    """Boosting is sequential: the first trees of a fit are the fit of fewer trees."""
    weighted, n = T.with_balanced_weights(table, "is_high_risk")
    prep = Pipeline(stages=T.prep_stages(["x", "noise"], [])).fit(weighted)
    rows = prep.transform(weighted).select("is_high_risk", "weight", "features").coalesce(1).persist()
    est = T._classifier("gradient_boosting", "is_high_risk")
    small, large = (est.copy(T._settings("gradient_boosting", est, {"rate": 0.1, "trees": k}, n)).fit(rows) for k in (4, 9))
    wide, x = compiled.with_components(rows)
    first, whole = compiled.probability_of(spark, large, x, [4, 9])
    (alone,) = compiled.probability_of(spark, small, x)
    worst = wide.agg(F.max(F.abs(first - alone)), F.max(F.abs(first - whole))).first()
    rows.unpersist()
    assert worst[0] < 1e-12 < worst[1]


def test_settings_that_share_a_fit():
    tries = T._combinations(T.GRIDS["random_forest"])
    assert sorted((most["depth"] or 99, most["trees"], sorted(tries[i]["trees"] for i in members)) for most, members in T._ensembles(tries)) == [(5, 200, [100, 200]), (10, 200, [100, 200]), (99, 200, [100, 200])]
    assert [len(m) for _, m in T._ensembles(T._combinations(T.GRIDS["logistic"]))] == [1, 1, 1, 1]


def test_areas_of_groups_equal_single_areas(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(rng.random() < 0.3), round(float(rng.random()), 2)) for g in (0, 1, 2) for _ in range(200)]
    df = spark.createDataFrame(rows, "g long, label int, score double")
    for per_split in (200_000, 40):
        got = {r["g"]: r["roc_auc"] for r in M.grouped_auc(df, ["g"], rows_per_split=per_split).collect()}
        assert got == pytest.approx({g: M.roc_auc(df.where(F.col("g") == g)).first()[0] for g in (0, 1, 2)})


def test_optimality_sees_a_wrong_coefficient(spark, table):
    weighted, n = T.with_balanced_weights(table, "is_high_risk")
    est = T._classifier("logistic", "is_high_risk")
    good, bad = (Pipeline(stages=[*T.prep_stages(["x", "noise"], []), est.copy({est.regParam: 1 / n, est.maxIter: k})]).fit(weighted) for k in (1_000, 1))
    rows = [T.optimality(m, weighted, "is_high_risk", 1 / n).collect() for m in (good, bad)]
    assert [r["feature"] for r in rows[0]] == ["x", "noise", "intercept"]
    assert max(abs(r["gradient"]) for r in rows[0]) < 1e-4 and rows[0][0]["gap"] < 1e-8 < 1e-4 < rows[1][0]["gap"]


def numpy_lloyd(points, keys, k, seed, starts):
    import hashlib

    best = None
    for s in range(starts):
        order = sorted(range(len(points)), key=lambda i: hashlib.md5(f"{seed + s}|{keys[i]}".encode()).hexdigest())
        centers = []
        for i in order:
            if tuple(points[i]) not in centers:
                centers.append(tuple(points[i]))
            if len(centers) == k:
                break
        centers = np.array(centers, dtype=float)
        for _ in range(300):
            near = ((points[:, None, :] - centers) ** 2).sum(axis=2).argmin(axis=1)
            new = np.array([points[near == j].mean(axis=0) if (near == j).any() else centers[j] for j in range(k)])
            shift = (((new - centers) / kmeans.GRID) ** 2).sum()
            centers = new
            if shift <= 1e-4:
                break
        cost = ((points[:, None, :] - centers) ** 2).sum(axis=2).min(axis=1).sum()
        if best is None or cost < best[0] * (1 - 1e-12):
            best = (cost, centers)
    return best


@pytest.mark.parametrize("compiled_rows", [0, 1_000_000])
def test_kmeans_equals_plain_lloyd(spark, monkeypatch, compiled_rows):
    monkeypatch.setattr(kmeans, "COMPILED_ROWS", compiled_rows)
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.4, (80, 2)) for c in ((0, 0), (3, 1), (1, 4))])
    points = np.round(points * kmeans.GRID).astype(int)
    points[5:40] = points[4]  # copies of one point count once when centres are drawn
    df = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(points)], "id long, a long, b long")
    found = kmeans.fit(df, ["a", "b"], "id", 3, seed=7, starts=4)
    cost, centers = numpy_lloyd(points, range(len(points)), 3, 7, 4)
    assert np.allclose(sorted(found.centers), sorted(map(tuple, centers)))
    assert found.cost * kmeans.GRID**2 == pytest.approx(cost, rel=1e-4)
    with pytest.raises(ValueError):
        kmeans.fit(df.where("id BETWEEN 4 AND 39"), ["a", "b"], "id", 3)


@pytest.mark.parametrize("pivot_rows", [1, 7, 10_000])
def test_splits_do_not_depend_on_the_rounds(spark, pivot_rows):
    df = spark.range(900).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, "x").when(F.col("id") < 5, "tiny").otherwise("y").alias("s"))
    got = stratified_split(df, "s", ["id"], 0.25, 3, pivot_rows=pivot_rows)
    want = stratified_split(df, "s", ["id"], 0.25, 3)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 810
    sizes = {r["s"]: (r["n"], r["t"]) for r in got.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    assert all(t == max(1, int(n * 0.25)) for n, t in sizes.values())
    folds = stratified_folds(df, "s", ["id"], 4, 3, pivot_rows=pivot_rows).groupBy("s", "fold").count().collect()
    assert max(r["count"] for r in folds if r["s"] == "y") - min(r["count"] for r in folds if r["s"] == "y") <= 1


def test_splits_of_keys_that_are_not_unique_end(spark):
    df = spark.range(60).select((F.col("id") % 2).alias("id"), F.lit("s").alias("s"))
    assert stratified_split(df, "s", ["id"], 0.5, pivot_rows=1).count() == 60


@pytest.mark.parametrize("rows, few", [(200_000, 24), (200_000, 2), (0, 2)])
def test_maps_as_conditions_table_and_join(spark, monkeypatch, rows, few):
    monkeypatch.setattr(packed, "PACKED_ROWS", rows)
    monkeypatch.setattr(packed, "FEW_KEYS", few)
    entries = [("f", f"k{i}", float(i)) for i in range(40)] + [("g", "k1", 7.0), ("g", "", 8.0), ("h.i", "it's", 9.0), ("h.i", "b", 1.0), ("h.i", "c", 2.0)]
    lookup = freeze(spark.createDataFrame(entries, "feature string, key string, value double"), "maps")
    maps = PackedMaps(lookup, "feature", "key", "value")
    df = spark.createDataFrame([("k3", "k1", "it's"), ("none", "", "b"), (None, None, None)], "a string, b string, c string")
    got = maps.attach(df, {"f": F.col("a"), "g": F.col("b"), "h.i": F.col("c")}, {"f": "x", "g": "y", "h.i": "z"}, missing=-1.0)
    assert sorted(map(tuple, got.select("x", "y", "z").collect())) == [(-1.0, -1.0, -1.0), (-1.0, 8.0, 1.0), (3.0, 7.0, 9.0)]
    assert bool(maps.joined) == (rows == 0) and ("Join" in got._jdf.queryExecution().executedPlan().toString()) == bool(maps.joined)


def test_hot_keys_come_from_one_pass_and_equal_rows_spread(spark, monkeypatch):
    left = spark.range(40_000, numPartitions=16).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, None).otherwise(F.col("id").cast("string")).alias("k"), F.lit("same").alias("v"))
    assert set(hot_keys(left, "k")) == {"hot", None}
    salts = left.where("k = 'hot'").select(row_salt(left).alias("s")).groupBy("s").count().collect()
    assert len(salts) > 8  # copies of one row in 16 partitions
    right = spark.createDataFrame([("hot", 1), ("7", 2)], "r string, x long")
    calls = []
    monkeypatch.setattr(joins, "hot_keys", lambda *a: calls.append(a) or ["hot", None])
    got = skew_safe_join(left, right, "k", "r", "left", broadcast_rows=0)
    assert len(calls) == 1 and got.count() == 40_000 and got.where("x = 1").count() == 13_334
    calls.clear()
    skew_safe_join(left, right, "k", "r", "left")
    assert not calls  # a small side needs no look at the other one


def test_edges_of_many_features_need_few_jobs(spark):
    df = materialize(spark.range(3_000).select("id", *[((F.col("id") * (7 + i)) % (11 + 40 * i)).cast("double").alias(f"f{i}") for i in range(8)], (F.col("id") % 4 == 0).cast("int").alias("y")), "edges")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("edges", "edges")
    try:
        W.rank_edges(df, [f"f{i}" for i in range(8)], "id", 5)
        jobs = len(tracker.getJobIdsForGroup("edges"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 16
    assert set(W.many_valued(df, [f"f{i}" for i in range(8)], 11)) == {f"f{i}" for i in range(1, 8)}


def test_modes_need_one_exchange_and_no_sort_aggregate(spark):
    txn = spark.createDataFrame([(1, "a", "p1"), (1, "b", "p2"), (1, "b", "p1"), (2, None, "p3"), (None, "a", "p1"), (3, "z", None)], "CustomerId long, few string, many string")
    plan = modal_categories(txn, ["few"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan
    wide = txn.unionByName(spark.range(200).selectExpr("10 + id % 5 as CustomerId", "'a' as few", "concat('v', id % 60) as many"))
    assert {(r["CustomerId"], r["few"], r["many"]) for r in modal_categories(wide, ["few", "many"]).where("CustomerId < 10").collect()} == {(1, "b", "p1"), (2, None, "p3"), (3, "z", None)}


def test_run_log_survives_repeats_and_broken_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    one, two = (spark.createDataFrame([(r, "param", "model_type", m)], runlog.LOG_SCHEMA) for r, m in (("a", "logistic"), ("b", "forest")))
    assert runlog.read_run_log(spark, path).count() == 0
    assert runlog.append_run_log(one, path) and not runlog.append_run_log(one, path)
    runlog.stage_rows(two, path, "x")
    assert runlog.read_run_log(spark, path).count() == 1
    assert runlog.append_run_log(two, path, "x") and not runlog.append_run_log(two, path, "x")
    assert {r["value"] for r in runlog.read_run_log(spark, path).collect()} == {"logistic", "forest"} and runlog.commits(spark, path).count() == 2


def test_judged_forests_grow_in_pieces(spark, table, monkeypatch):
    """Deep forests are judged by their own votes: their nodes never come to the driver as rows, and it grows few trees at a time."""
    monkeypatch.setattr(compiled, "read_ensemble", None)
    monkeypatch.setattr(T, "TREES_PER_FIT", 4)
    weighted, n = T.with_balanced_weights(table, "is_high_risk")
    tries = T._combinations({"trees": [3, 10], "depth": [None, 2]})
    found = T.cross_validate(weighted, "is_high_risk", ["CustomerId"], T.prep_stages(["x", "noise"], ["cat"]), "random_forest", tries, n, folds=2).collect()
    assert {(r["setting"], r["fold"]) for r in found} == {(i, k) for i in range(4) for k in range(2)} and min(r["roc_auc"] for r in found) > 0.6
    prep = Pipeline(stages=T.prep_stages(["x", "noise"], ["cat"])).fit(weighted)
    rows = prep.transform(weighted).select("is_high_risk", "weight", "features").coalesce(1).persist()
    test = materialize(prep.transform(weighted).select(F.col("CustomerId").alias("row"), F.col("is_high_risk").alias("label"), "features"), "rows")
    est = T._classifier("random_forest", "is_high_risk")
    wide, (few, all_) = T.forest_scores(est, rows, test, [3, 10])
    assert T._pieces([3, 10]) == [(0, 3), (3, 4), (4, 8), (8, 10)]
    first = est.copy({est.numTrees: 3}).fit(rows).transform(test).select("row", vector_to_array("probability")[1].alias("want"))
    worst = wide.withColumns({"few": few, "all": all_}).join(first, "row").agg(F.max(F.abs(F.col("few") - F.col("want"))), F.min("all"), F.max("all"), F.count("*")).first()
    rows.unpersist()
    assert worst[0] < 1e-12 and 0 <= worst[1] < 0.5 < worst[2] <= 1 and worst[3] == 400


def test_many_points_are_assigned_as_arrays(spark, monkeypatch):
    """Iterations over many rows never evaluate expressions per start: code of ten starts is too long to be compiled."""
    monkeypatch.setattr(kmeans, "COMPILED_ROWS", 0)
    monkeypatch.setattr(kmeans, "_turns", None)
    df = spark.createDataFrame([(i, (i % 3) * 5_000_000 + i, (i % 2) * 1_000) for i in range(120)], "id long, `a.b` long, y long").withColumnRenamed("a.b", "x")
    found = kmeans.fit(df, ["x", "y"], "id", 3, seed=7)
    assert sorted(round(m[0] / 5_000_000) for m in found.centers) == [0, 1, 2] and found.iterations < 20


def test_models_share_folds_and_runs_of_trees_grow_side_by_side(spark, table, monkeypatch):
    """Preparation is fitted once per fold and once for the refits, whatever the models; no run of trees waits for another run of its forest."""
    fits, together, write, fit = [], threading.Barrier(4, timeout=120), T.materialize, T.TabularPrep._fit
    monkeypatch.setattr(T, "TREES_PER_FIT", 2)
    monkeypatch.setattr(T.TabularPrep, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    monkeypatch.setattr(T, "materialize", lambda df, name: (name == "votes" and together.wait(), write(df, name))[1])
    grids = {"random_forest": {"trees": [2, 4], "depth": [2]}, "logistic": {"C": [0.1, 1]}, "gradient_boosting": {"rate": [0.1], "trees": [1, 2]}}
    models = T.train_all(table, grids=grids, folds=2)
    assert [m.name for m in models] == list(grids) and [sorted((s, f) for s, f, _ in m.fold_scores) for m in models] == [[(0, 0), (0, 1), (1, 0), (1, 1)]] * 3
    assert len(fits) == 3
