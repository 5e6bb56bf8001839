"""Train, tune, compare and record classifiers with pyspark.ml."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c, numeric_columns
from riskloom.functions.order_stats import exact_quantiles
from riskloom.operators.metrics import evaluate, fingerprint, grouped_auc
from riskloom.operators.normalize import population_moments
from riskloom.operators.split import model_split, stratified_folds
from riskloom.operators.trees import Fold, boosted_margins, forest_votes as array_votes
from riskloom.plans.compiled import probability_of, with_components
from riskloom.session import materialize, ship_package
from riskloom.sources.tables import write_table

SEED = 42  # fixed value
FOLDS = 5
PARALLELISM = 14  # fits side by side, of all models
ROWS_PER_PART = 100_000  # of a fit that has others beside it
ROWS_OF_SPREAD_PART = 8_000  # of a forest that is fitted by itself
LONGEST_FIRST = ("gradient_boosting", "random_forest", "logistic")  # trees of boosting follow one another
TREES_PER_FIT = 25  # trees of a judged forest that are grown at a time: the driver holds their nodes
UNLIMITED_DEPTH = 30  # deepest tree the ml library allows
BOOSTED_DEPTH = 3  # fixed value
ARRAY_VALUES = 32_000_000  # rows x features of a fold up to which tasks that hold it as bytes judge trees; larger ones are left to the ml library, which spreads rows
# fixed values: search grids per model
GRIDS: dict[str, dict[str, list]] = {
    "logistic": {"C": [0.01, 0.1, 1, 10]},
    "random_forest": {"trees": [100, 200], "depth": [None, 5, 10]},
    "gradient_boosting": {"rate": [0.05, 0.1], "trees": [100, 200]},
}


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TabularPrep(Estimator):
    """Median / mode imputation and standardisation as one SQL projection.

    The fitted statistics become literals of a ``SQLTransformer``, so the fitted
    stage runs inside generated code and saves with the pipeline.
    """

    def __init__(self, numeric: list[str], categorical: list[str]):
        super().__init__()
        self.numeric, self.categorical = numeric, categorical

    def copy(self, extra=None):
        return TabularPrep(self.numeric, self.categorical)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        medians = exact_quantiles(df, self.numeric, [0.5])
        filled = {n: F.coalesce(F.when(~F.isnan(c(n).cast("double")), c(n).cast("double")), F.lit(medians[n][0] or 0.0)) for n in self.numeric}
        moments = population_moments(df, filled)
        parts = ["*"]
        for n in self.numeric:
            name, median = _sql_name(n), medians[n][0] or 0.0
            mean, std = moments[n][0] or 0.0, moments[n][1] or 1.0
            parts.append(f"(coalesce(nullif(cast({name} as double), cast('NaN' as double)), {median!r}D) - {mean!r}D) / {std!r}D as {_sql_name('__n_' + n)}")
        texts = df.select(*[c(n).cast("string").alias(n) for n in self.categorical])
        tops = texts.agg(*[F.mode(c(n), True).alias(n) for n in self.categorical]).first().asDict() if self.categorical else {}  # the smallest of equals
        for n in self.categorical:
            parts.append(f"coalesce(cast({_sql_name(n)} as string), {_sql_text(tops[n] or '')}) as {_sql_name('__c_' + n)}")
        return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def prep_stages(numeric: list[str], categorical: list[str]) -> list:
    """Imputation, scaling, one-hot (unknown values encode to zeros) and assembly."""
    stages: list = [TabularPrep(numeric, categorical)]
    inputs = [f"__n_{n}" for n in numeric]
    if categorical:
        indexed, hot = [f"__i_{n}" for n in categorical], [f"__h_{n}" for n in categorical]
        stages += [StringIndexer(inputCols=[f"__c_{n}" for n in categorical], outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True, handleInvalid="error")]  # the last index is the unknown value: no slot
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def route_columns(df: DataFrame, label: str, keys: list[str]) -> tuple[list[str], list[str]]:
    """Numeric feature columns, and all others (text, booleans, dates) that are encoded as text; label and keys are no features."""
    skip = {label, "fold", "weight", *keys}
    numeric = [n for n in numeric_columns(df) if n not in skip]
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    return numeric, [f.name for f in df.schema.fields if f.name not in skip and f.name not in numeric and not isinstance(f.dataType, nested)]


def with_balanced_weights(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Weight ``n / (2 * n_class)`` per row, from one count per class."""
    counts = {r[label]: r["count"] for r in df.groupBy(c(label)).count().collect()}  # two classes
    n = sum(counts.values())
    weight = F.create_map(*[F.lit(x) for y, k in counts.items() for x in (y, n / (len(counts) * k))])
    return df.withColumn("weight", F.element_at(weight, c(label))), n


def _classifier(name: str, label: str):
    if name == "logistic":
        return LogisticRegression(labelCol=label, weightCol="weight", maxIter=1000, standardization=False)
    if name == "random_forest":
        return RandomForestClassifier(labelCol=label, seed=SEED, cacheNodeIds=True)  # else every level sends the trees and walks them from their roots
    if name == "gradient_boosting":
        return GBTClassifier(labelCol=label, seed=SEED, maxDepth=BOOSTED_DEPTH)
    raise ValueError(f"Unsupported model: {name!r}")


def _settings(name: str, est, values: dict, n_rows: float) -> dict:
    """Search values in the terms of the ml estimator."""
    if name == "logistic":
        return {est.regParam: 1.0 / (values["C"] * n_rows)}
    if name == "random_forest":
        depth = UNLIMITED_DEPTH if values["depth"] is None else values["depth"]
        return {est.numTrees: values["trees"], est.maxDepth: depth}
    return {est.stepSize: values["rate"], est.maxIter: values["trees"]}


def _combinations(grid: dict[str, list]) -> list[dict]:
    out: list[dict] = [{}]
    for key, options in grid.items():
        out = [{**o, key: v} for o in out for v in options]
    return out


@dataclass
class TrainedModel:
    name: str
    model: PipelineModel = field(repr=False)
    features: list[str]
    metrics: dict[str, float]
    best_params: dict
    cv_scores: list[tuple[dict, float]]
    predictions: DataFrame = field(repr=False)
    fold_scores: list[tuple[int, int, float]] = field(default_factory=list, repr=False)  # setting, fold, ROC-AUC

    def importances(self) -> DataFrame | None:
        """``feature, importance`` with expanded names, for tree models."""
        stage = self.model.stages[-1]
        if not hasattr(stage, "featureImportances"):
            return None
        scores = stage.featureImportances.toArray()
        rows = [(name, float(x)) for name, x in zip(_vector_names(self.predictions), scores)]
        return self.predictions.sparkSession.createDataFrame(rows, "feature string, importance double")


def _vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Plain names of an assembled vector's components."""
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    return [_plain_name(names[i]) for i in sorted(names)]


def _plain_name(name: str) -> str:
    """Drop the stage prefixes: ``__h_col___c_col_value`` and ``__n_col`` become plain names."""
    return name[4:] if name.startswith(("__n_", "__h_")) else name


def top_importances(importances: DataFrame, k: int = 20) -> DataFrame:
    return importances.orderBy(F.col("importance").desc(), "feature").limit(k)


def write_importances(importances: DataFrame, path: str) -> str:
    """Save the importance table (one row per expanded feature)."""
    return write_table(importances.coalesce(1), path)


def optimality(model: PipelineModel, df: DataFrame, label: str, penalty: float) -> DataFrame:
    """``feature, coefficient, gradient, gap``: how far a logistic fit is from its optimum, over all rows of ``df``.

    One aggregate gives the gradient and the curvature of the weighted, penalised objective at the fitted coefficients. ``gap`` is half the squared Newton
    decrement: about what the objective could still fall. ``df`` has the label and a weight column ``weight``; the intercept is not penalised.
    """
    *_, fitted = model.stages
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df)
    rows, x = with_components(prepared, out="__x")
    x = [*x, F.lit(1.0)]
    beta = [*fitted.coefficients.toArray().tolist(), float(fitted.intercept)]
    (p,) = probability_of(df.sparkSession, fitted, x[:-1])
    n = len(beta)
    w = F.col("weight").cast("double")
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    ready = rows.select(F.array(*x).alias("x"), (w * (p - c(label))).alias("r"), (w * p * (1 - p)).alias("h"), w.alias("w"))
    sums = ready.agg(F.sum("w").alias("w"), F.array(*[F.sum(F.col("r") * F.col("x")[i]) for i in range(n)]).alias("g"), F.array(*[F.sum(F.col("h") * F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).alias("c")).first()
    free = np.array([penalty] * (n - 1) + [0.0])
    gradient = np.array(sums["g"]) / sums["w"] + free * np.array(beta)
    curvature = np.diag(free)
    for (i, j), v in zip(pairs, sums["c"]):
        curvature[i, j] += v / sums["w"]
        if i != j:
            curvature[j, i] += v / sums["w"]
    gap = float(gradient @ np.linalg.solve(curvature, gradient)) / 2
    names = [*_vector_names(prepared), "intercept"]
    return df.sparkSession.createDataFrame([(name, float(b), float(g), gap) for name, b, g in zip(names, beta, gradient)], "feature string, coefficient double, gradient double, gap double")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``score`` (probability of class 1) and integer ``prediction``."""
    out = model.transform(df)
    return out.withColumn("score", vector_to_array("probability")[1]).withColumn("prediction", F.col("prediction").cast("int"))


def _ensembles(tries: list[dict]) -> list[tuple[dict, list[int]]]:
    """Settings that one fit serves: those that differ in the number of trees alone, under the largest number.

    Trees of an ensemble are grown one after another, so its first n trees are an ensemble of n.
    """
    shared: dict[tuple, list[int]] = {}
    for i, t in enumerate(tries):
        shared.setdefault(tuple((k, v) for k, v in t.items() if k != "trees") if "trees" in t else (i,), []).append(i)
    return [(max((tries[i] for i in members), key=lambda t: t.get("trees", 0)), members) for members in shared.values()]


def _pieces(sizes: list[int]) -> list[tuple[int, int]]:
    """(first, stop) of the runs of trees a forest is grown in: ``TREES_PER_FIT`` at most, none across one of ``sizes``."""
    cuts = sorted({0, *sizes, *range(0, max(sizes), TREES_PER_FIT)})
    return list(zip(cuts, cuts[1:]))


def forest_votes(est: RandomForestClassifier, fit_rows: DataFrame, test_rows: DataFrame, piece: tuple[int, int]) -> DataFrame:
    """``row, label, first, votes`` of ``test_rows`` by one run of trees, which has a seed of its own.

    The driver holds the nodes of one run, and votes come from the fitted forest itself, whose deep trees would make too large an expression.
    """
    first, stop = piece
    forest = est.copy({est.numTrees: stop - first, est.seed: SEED + first}).fit(fit_rows)
    return materialize(forest.transform(test_rows).select("row", "label", F.lit(first).alias("first"), vector_to_array("rawPrediction")[1].alias("votes")), "votes")


def first_trees(votes: list[DataFrame], by: list[str], pieces: list[tuple[int, int]], sizes: list[int]) -> tuple[DataFrame, list[Column]]:
    """One row per ``by``, and the probability of class 1 by the first n trees, for each n of ``sizes``: the votes of the runs add up."""
    wide = _union(votes).groupBy(*by).agg(*[F.max(F.when(F.col("first") == first, F.col("votes"))).alias(f"v{first}") for first, _ in pieces])
    return wide, [sum((F.col(f"v{first}") for first, stop in pieces if stop <= n), F.lit(0.0)) / n for n in sizes]


def forest_scores(est: RandomForestClassifier, fit_rows: DataFrame, test_rows: DataFrame, sizes: list[int]) -> tuple[DataFrame, list[Column]]:
    """``test_rows`` (with ``row``, ``label``, ``features``) and the probability of class 1 by the first n trees, for each n of ``sizes``.

    Trees of a forest are independent, so runs of them are fitted one after another.
    """
    pieces = _pieces(sizes)
    return first_trees([forest_votes(est, fit_rows, test_rows, piece) for piece in pieces], ["row", "label"], pieces, sizes)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _in_parts(df: DataFrame, rows: int) -> DataFrame:
    """Fewer partitions for few rows: every level of every tree is a job over all of them, and fits run side by side."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_PART)))


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Rows of a forest that is fitted whole: all cores but two, which the small jobs of boosting beside it need, grow its trees."""
    return df.repartition(max(1, min(df.sparkSession.sparkContext.defaultParallelism - 2, rows // ROWS_OF_SPREAD_PART)))


def prepare_folds(df: DataFrame, label: str, keys: list[str], stages: list, n_rows: int, folds: int, pool: ThreadPool) -> list[tuple[int, DataFrame, DataFrame]]:
    """Number, fit rows (kept in memory) and test rows of every stratified fold; preparation is fitted once per fold, for all models."""
    folded = materialize(stratified_folds(df, label, keys, folds, SEED), "folds")

    def prepared(fold: int) -> tuple:
        inside, outside = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        prep = Pipeline(stages=stages).fit(inside)
        fit_rows = _in_parts(prep.transform(inside).select(c(label), "weight", "features"), int(n_rows * (folds - 1) / folds)).persist()
        fit_rows.count()
        return fold, fit_rows, materialize(prep.transform(outside).select(F.monotonically_increasing_id().alias("row"), c(label).alias("label"), "features"), "fold-rows")

    return pool.map(prepared, range(folds), chunksize=1)


def pack_folds(parts: list[tuple[int, DataFrame, DataFrame]], label: str, pool: ThreadPool) -> DataFrame:
    """One row per fold: its fit and test rows as binned arrays (see ``operators.trees``), a byte a value."""

    def packed(part: tuple[int, DataFrame, DataFrame]) -> DataFrame:
        fold, fit_rows, test_rows = part

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if found := [batch for batch in batches if batch.num_rows]:
                table = pa.Table.from_batches(found)
                rows, labels = (table.column(n).combine_chunks() for n in ("row", "label"))
                x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(table), -1)
                held = rows.is_valid().to_numpy(zero_copy_only=False)
                y = labels.to_numpy(zero_copy_only=False)
                arrays = Fold.of(x[~held], y[~held], x[held])
                columns = [arrays.bins, arrays.labels, arrays.test, y[held].astype(np.int8), rows.filter(rows.is_valid()).to_numpy()]
                yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([x.shape[1]], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in columns]], PACKED)

        either = fit_rows.select(F.lit(None).cast("long").alias("row"), c(label).cast("int").alias("label"), vector_to_array("features").alias("x")).unionByName(
            test_rows.select("row", F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x")))
        return materialize(either.coalesce(1).mapInArrow(work, "fold int, width int, bins binary, labels binary, test binary, test_labels binary, rows binary"), "packed-fold")

    PACKED = ["fold", "width", "bins", "labels", "test", "test_labels", "rows"]
    ship_package(parts[0][1].sparkSession)
    return _union(pool.map(packed, parts, chunksize=1))


def _unpacked(row: dict) -> tuple[Fold, pa.Array, pa.Array]:
    """The fold, and labels and row numbers of its test rows."""
    arrays = [np.frombuffer(row[n], dtype=kind) for n, kind in (("bins", np.uint8), ("labels", np.uint8), ("test", np.uint8), ("test_labels", np.int8), ("rows", np.int64))]
    bins, labels, test, test_labels, rows = arrays
    return Fold(bins.reshape(-1, row["width"]), labels, test.reshape(-1, row["width"])), pa.array(test_labels.astype(np.int32)), pa.array(rows)


def _of_each(packed: DataFrame, jobs: list[tuple], schema: str, work: Callable[[dict], Iterator[list[pa.Array]]], out: str) -> DataFrame:
    """What ``work`` gives for each of ``jobs`` (the fold is their column ``fold``), every one a task of its own, in the order they stand."""
    names = [part.split()[0] for part in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for columns in work(row):
                    yield pa.RecordBatch.from_arrays(columns, names)

    context = packed.sparkSession.sparkContext
    table = packed.sparkSession.createDataFrame(context.parallelize(jobs, len(jobs)), schema)
    return table.join(F.broadcast(packed), "fold").mapInArrow(run, out)


def boosted_scores(packed: DataFrame, jobs: list[tuple[int, float, list[int], list[int]]]) -> DataFrame:
    """``setting, fold, label, score`` of test rows by boosted trees; jobs are fold, rate, and numbers of trees with their settings."""

    def work(row: dict) -> Iterator[list[pa.Array]]:
        fold, labels, _ = _unpacked(row)
        settings: dict[int, list[int]] = {}
        for n, setting in zip(row["sizes"], row["settings"]):
            settings.setdefault(n, []).append(setting)
        for n, margin in zip(sorted(settings), boosted_margins(fold, sorted(settings), row["rate"], BOOSTED_DEPTH)):
            for setting in settings[n]:
                yield [pa.repeat(pa.scalar(setting, pa.int32()), len(margin)), pa.repeat(pa.scalar(row["fold"], pa.int32()), len(margin)), labels, pa.array(1 / (1 + np.exp(-2 * margin)))]

    return _of_each(packed, jobs, "fold int, rate double, sizes array<int>, settings array<int>", work, "setting int, fold int, label int, score double")


def voted_rows(packed: DataFrame, jobs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """``group, fold, row, label, first, votes`` of test rows by runs of a forest's trees; jobs are fold, group, depth, and first and last tree of the run."""

    def work(row: dict) -> Iterator[list[pa.Array]]:
        fold, labels, rows = _unpacked(row)
        votes = array_votes(fold, row["first"], row["stop"], row["depth"], SEED)
        same = lambda n: pa.repeat(pa.scalar(row[n], pa.int32()), len(votes))
        yield [same("group"), same("fold"), rows, labels, same("first"), pa.array(votes)]

    return _of_each(packed, jobs, "fold int, group int, depth int, first int, stop int", work, "group int, fold int, row long, label int, first int, votes double")


def start_array_judging(packed: DataFrame, folds: list[int], name: str, tries: list[dict], pool: ThreadPool) -> Callable[[], DataFrame]:
    """As :func:`start_judging`, over folds that tasks hold as binned arrays."""
    shared = _ensembles(tries)
    if name == "gradient_boosting":
        jobs = [(fold, float(most["rate"]), [tries[i]["trees"] for i in members], members) for most, members in shared for fold in folds]
        scores = pool.apply_async(lambda: materialize(boosted_scores(packed, jobs), "fold-scores"))
        return lambda: grouped_auc(scores.get(), ["setting", "fold"])
    sizes = [[tries[i]["trees"] for i in members] for _, members in shared]
    depths = [most["depth"] or UNLIMITED_DEPTH for most, _ in shared]
    runs = [(fold, group, depths[group], *piece) for group in sorted(range(len(shared)), key=lambda g: -depths[g]) for piece in _pieces(sizes[group]) for fold in folds]
    found = pool.apply_async(lambda: materialize(voted_rows(packed, runs), "array-votes"))

    def voted() -> DataFrame:
        tables = []
        for group, ((_, members), n) in enumerate(zip(shared, sizes)):
            rows, scores = first_trees([found.get().where(F.col("group") == group)], ["fold", "row", "label"], _pieces(n), n)
            tables.append(_of_settings(members, scores, rows))
        return grouped_auc(_union(tables), ["setting", "fold"])

    return voted


def _of_settings(members: list[int], scores: list[Column], rows: DataFrame) -> DataFrame:
    each = F.array(*[F.struct(F.lit(i).alias("setting"), p.alias("score")) for i, p in zip(members, scores)])
    return materialize(rows.select("fold", "label", F.inline(each)), "fold-scores")


def _packs(parts: list[tuple[int, DataFrame, DataFrame]], names: list[str], n_inside: float) -> bool:
    """Whether trees are judged and the folds are small enough to be held by a task."""
    return any(name != "logistic" for name in names) and n_inside * len(with_components(parts[0][2])[1]) <= ARRAY_VALUES


def start_judging(parts: list[tuple[int, DataFrame, DataFrame]], label: str, name: str, tries: list[dict], n_inside: float, pool: ThreadPool) -> Callable[[], DataFrame]:
    """Queues the fits of every setting and fold; the function returned waits for them and gives ``setting, fold, roc_auc``.

    Settings that differ in the number of trees share one fit, and runs of a forest's trees are fits of their own. The scores of all settings and folds stand in one
    table, whose exact areas are found in one pass.
    """
    est, shared = _classifier(name, label), _ensembles(tries)

    def with_setting(most: dict):
        return est.copy(_settings(name, est, most, n_inside))

    def scores_of(job) -> DataFrame:
        most, members, (fold, fit_rows, test_rows) = job
        rows, x = with_components(test_rows)
        found = probability_of(rows.sparkSession, with_setting(most).fit(fit_rows), x, [tries[i]["trees"] for i in members] if "trees" in most else None)
        return _of_settings(members, found, rows.withColumn("fold", F.lit(fold)))

    def votes_of(job) -> DataFrame:
        most, piece, (fold, fit_rows, test_rows) = job
        return forest_votes(with_setting(most), fit_rows, test_rows, piece).withColumn("fold", F.lit(fold))

    if name != "random_forest":
        pending = pool.map_async(scores_of, [(most, members, part) for most, members in shared for part in parts], chunksize=1)
        return lambda: grouped_auc(_union(pending.get()), ["setting", "fold"])
    sizes = [[tries[i].get("trees", est.getNumTrees()) for i in members] for _, members in shared]
    runs = [pool.map_async(votes_of, [(most, piece, part) for piece in _pieces(n) for part in parts], chunksize=1) for (most, _), n in zip(shared, sizes)]

    def voted() -> DataFrame:
        tables = []
        for (_, members), n, votes in zip(shared, sizes, runs):
            rows, found = first_trees(votes.get(), ["fold", "row", "label"], _pieces(n), n)
            tables.append(_of_settings(members, found, rows))
        return grouped_auc(_union(tables), ["setting", "fold"])

    return voted


def judging(parts: list[tuple[int, DataFrame, DataFrame]], label: str, tries: dict[str, list[dict]], n_inside: float, pool: ThreadPool) -> dict[str, Callable[[], DataFrame]]:
    """Queues the fits of all models, and gives for each what waits for them; trees are judged as arrays where a task can hold a fold."""
    if not _packs(parts, list(tries), n_inside):
        return {name: start_judging(parts, label, name, settings, n_inside, pool) for name, settings in tries.items()}
    packed = pack_folds(parts, label, pool)
    return {name: start_judging(parts, label, name, settings, n_inside, pool) if name == "logistic" else start_array_judging(packed, [fold for fold, _, _ in parts], name, settings, pool)
            for name, settings in tries.items()}


def cross_validate(df: DataFrame, label: str, keys: list[str], stages: list, name: str, tries: list[dict], n_rows: int, folds: int = FOLDS, parallelism: int = PARALLELISM) -> DataFrame:
    """``setting, fold, roc_auc`` of every setting of one model over stratified folds."""
    with ThreadPool(parallelism) as pool:  # threads submit jobs side by side
        parts = prepare_folds(df, label, keys, stages, n_rows, folds, pool)
        found = judging(parts, label, {name: tries}, n_rows * (folds - 1) / folds, pool)[name]()
    for _, fit_rows, _ in parts:
        fit_rows.unpersist()
    return found


def search(train_df: DataFrame, test_df: DataFrame, grids: dict[str, dict[str, list]], label: str, keys: list[str], folds: int, parallelism: int) -> list[TrainedModel]:
    """Grid search of every model by cross-validated ROC-AUC, refit on all training rows, evaluation on test rows.

    Folds are prepared once for all models, whose fits share one pool: those that take longest begin first, and a model is refitted as soon as its own settings are judged.
    """
    tries = {name: _combinations(grid) for name, grid in grids.items()}
    estimators = {name: _classifier(name, label) for name in grids}
    numeric, categorical = route_columns(train_df, label, keys)
    weighted, n = with_balanced_weights(train_df, label)
    stages = prep_stages(numeric, categorical)
    prepared = Pipeline(stages=stages).fit(weighted)

    def finish(name: str, judged: Callable[[], DataFrame] | None) -> TrainedModel:
        est, scores, by_fold = estimators[name], [math.nan] * len(tries[name]), []
        if judged is not None:
            by_fold = [tuple(r) for r in judged().select("setting", "fold", "roc_auc").collect()]  # settings x folds
            scores = [sum(a for s, _, a in by_fold if s == i) / folds for i in range(len(scores))]
        best = tries[name][max(range(len(scores)), key=lambda i: -math.inf if math.isnan(scores[i]) else scores[i])]
        ready = prepared.transform(weighted).select(c(label), "weight", "features")
        rows = (_spread(ready, n) if name == "random_forest" else _in_parts(ready, n)).persist()
        final = est.copy(_settings(name, est, best, n)).fit(rows)
        rows.unpersist()
        model = PipelineModel(stages=[*prepared.stages, final])
        predictions = materialize(predict(model, test_df), "predictions")  # deep trees are sent to tasks once
        row = evaluate(predictions.select(c(label).alias("label"), "prediction", "score")).first().asDict()
        return TrainedModel(name, model, numeric + categorical, row, best, list(zip(tries[name], scores)), predictions, by_fold)

    searched = sorted((name for name in grids if len(tries[name]) > 1), key=LONGEST_FIRST.index)
    with ThreadPool(parallelism) as pool, ThreadPool(max(1, len(grids))) as models:  # threads submit jobs side by side
        parts = prepare_folds(weighted, label, keys, stages, n, folds, pool) if searched else []
        judged = judging(parts, label, {name: tries[name] for name in searched}, n * (folds - 1) / folds, pool) if searched else {}
        out = models.map(lambda name: finish(name, judged.get(name)), list(grids), chunksize=1)
    for _, fit_rows, _ in parts:
        fit_rows.unpersist()
    return out


def train(
    train_df: DataFrame,
    test_df: DataFrame,
    name: str,
    label: str = "is_high_risk",
    keys: tuple[str, ...] = ("CustomerId",),
    grid: dict[str, list] | None = None,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
) -> TrainedModel:
    """The search of one model."""
    grid = GRIDS[name] if grid is None and name in GRIDS else (grid or {})
    return search(train_df, test_df, {name: grid}, label, list(keys), folds, parallelism)[0]


def train_all(df: DataFrame, label: str = "is_high_risk", keys: tuple[str, ...] = ("CustomerId",), test_frac: float = 0.2,
              grids: dict[str, dict[str, list]] | None = None, folds: int = FOLDS, parallelism: int = PARALLELISM) -> list[TrainedModel]:
    """Split once, then train every model of the grid table on the same parts."""
    train_df, test_df = (materialize(part, "model-part") for part in model_split(df, label, list(keys), test_frac, SEED))
    return search(train_df, test_df, GRIDS if grids is None else grids, label, list(keys), folds, parallelism)


def leaderboard(models: list[TrainedModel], spark: SparkSession) -> DataFrame:
    """Metrics per model, best ROC-AUC first; the first row is the champion."""
    order = ("accuracy", "precision", "recall", "f1", "roc_auc")
    rows = [(m.name, *[float(m.metrics[k]) if m.metrics[k] is not None else None for k in order]) for m in models]
    table = spark.createDataFrame(rows, "model string, " + ", ".join(f"{k} double" for k in order))
    return table.orderBy(F.col("roc_auc").desc(), "model")


def champion(models: list[TrainedModel]) -> TrainedModel:
    return max(models, key=lambda m: m.metrics["roc_auc"] or 0.0)


def run_log(models: list[TrainedModel], data: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    """``run_id, kind, key, value`` rows: parameters, metrics, data hash, tags and the champion's reason."""
    data_hash = fingerprint(data).first()["data_hash"]
    best, rows = champion(models), []
    for m in models:
        run = uuid.uuid4().hex
        rows += [(run, "param", "model_type", m.name), (run, "param", "data_hash", data_hash)]
        rows += [(run, "param", k, str(v)) for k, v in m.best_params.items()]
        rows += [(run, "metric", k, repr(v)) for k, v in m.metrics.items()]
        rows += [(run, "tag", k, v) for k, v in (tags or {}).items()]
        if m is best:
            rows.append((run, "tag", "champion_reason", "highest ROC-AUC"))
    return data.sparkSession.createDataFrame(rows, "run_id string, kind string, key string, value string")
