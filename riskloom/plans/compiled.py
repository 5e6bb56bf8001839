"""Fitted classifiers as column expressions: one projection over the prepared columns, for batches and streams alike.

A linear model is a sum of products. Small tree models become nested conditions. Larger ones become a walk over arrays of their nodes (one literal
for the whole ensemble), so the expression stays as small for 200 deep trees as for one; its steps are bounded by the deepest tree. The trees of an ensemble stand in
order, so the score of its first trees alone comes from the same expression.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import OneHotEncoderModel, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.session import scratch_path

NESTED_NODES = 400  # nodes of an ensemble up to which it becomes nested conditions
NESTED_DEPTH = 10


@dataclass(frozen=True)
class Ensemble:
    """The nodes of all trees in one list; a leaf has no children (-1). ``boosted`` values add up to a margin, others are mean probabilities."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    roots: list[int]
    depth: int
    boosted: bool


def read_ensemble(spark: SparkSession, model: RandomForestClassificationModel | GBTClassificationModel) -> Ensemble:
    """The nodes of a fitted ensemble, from its saved form (as many rows as the model has nodes)."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    boosted = isinstance(model, GBTClassificationModel)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    weights = model.treeWeights
    out = Ensemble([], [], [], [], [], [], max(t.depth for t in model.trees), boosted)
    start = 0
    for i, r in enumerate(rows):
        if r["id"] == 0:
            start = i
            out.roots.append(i)
        split, leaf = r["split"], r["leftChild"] < 0
        left, right, threshold = r["leftChild"], r["rightChild"], 0.0
        if not leaf:
            threshold = split["leftCategoriesOrThreshold"][0] if split["numCategories"] < 0 else 0.5
            if split["numCategories"] > 2:
                raise ValueError("splits on indexed categories are not supported; encode them one-hot")
            if split["numCategories"] == 2 and split["leftCategoriesOrThreshold"] == [1.0]:
                left, right = right, left
        stats = r["impurityStats"]
        value = r["prediction"] * weights[r["treeID"]] if boosted else stats[1] / sum(stats)
        out.feature.append(split["featureIndex"])
        out.threshold.append(threshold)
        out.left.append(-1 if leaf else start + left)
        out.right.append(-1 if leaf else start + right)
        out.value.append(value)
    return out


def _tree(model: Ensemble, at: int, x: list[Column]) -> Column:
    if model.left[at] < 0:
        return F.lit(model.value[at])
    return F.when(x[model.feature[at]] <= F.lit(model.threshold[at]), _tree(model, model.left[at], x)).otherwise(_tree(model, model.right[at], x))


def _total(values: list[Column]) -> Column:
    total = F.lit(0.0)
    for v in values:
        total = total + v
    return total


def _probability(total: Column, trees: int, boosted: bool) -> Column:
    return 1 / (1 + F.exp(-2 * total)) if boosted else total / trees


def ensemble_probabilities(model: Ensemble, x: list[Column], stages: list[int] | None = None) -> list[Column]:
    """Probability of class 1 by the first ``n`` trees, for each n of ``stages`` (default: all trees)."""
    stages = stages or [len(model.roots)]
    if len(model.value) <= NESTED_NODES and model.depth <= NESTED_DEPTH:
        trees = [_tree(model, root, x) for root in model.roots]
        return [_probability(_total(trees[:n]), n, model.boosted) for n in stages]
    shape = "struct<feature: array<int>, threshold: array<double>, left: array<int>, right: array<int>, value: array<double>, roots: array<int>>"
    nodes = F.from_json(F.lit(json.dumps({n: getattr(model, n) for n in ("feature", "threshold", "left", "right", "value", "roots")})), shape)

    def leaf_value(row: Column, root: Column) -> Column:
        n, at_x = row["n"], row["x"]
        step = lambda at, _: (F.when(F.get(n["left"], at) < 0, at).when(F.get(at_x, F.get(n["feature"], at)) <= F.get(n["threshold"], at), F.get(n["left"], at))
                              .otherwise(F.get(n["right"], at)))
        return F.get(n["value"], F.aggregate(F.sequence(F.lit(1), F.lit(max(model.depth, 1))), root, step))

    row = F.array(F.struct(nodes.alias("n"), F.array(*x).alias("x")))  # bound once per row
    values = F.transform(row, lambda r: F.transform(r["n"]["roots"], lambda root: leaf_value(r, root)))[0]
    sums = F.transform(F.array(values), lambda v: F.array(*[F.aggregate(F.slice(v, 1, n), F.lit(0.0), lambda a, b: a + b) for n in stages]))[0]
    return [_probability(F.get(sums, F.lit(i)), n, model.boosted) for i, n in enumerate(stages)]


def with_components(df: DataFrame, column: str = "features", out: str = "x") -> tuple[DataFrame, list[Column]]:
    """``df`` with an assembled vector of known width as the array ``out``, and its components."""
    attrs = df.schema[column].metadata["ml_attr"]
    width = attrs.get("num_attrs") or sum(len(group) for group in attrs["attrs"].values())
    return df.withColumn(out, vector_to_array(column)).drop(column), [c(out)[i] for i in range(width)]


def _inputs(stages: list[Transformer]) -> list[Column]:
    """What the assembled vector holds, in terms of the prepared columns."""
    (assembler,) = [s for s in stages if isinstance(s, VectorAssembler)]
    labels: dict[str, list[str]] = {}
    source: dict[str, str] = {}
    for s in stages:
        if isinstance(s, StringIndexerModel):
            for name, out, values in zip(s.getInputCols(), s.getOutputCols(), s.labelsArray):
                labels[out], source[out] = list(values), name
        if isinstance(s, OneHotEncoderModel):
            for name, out in zip(s.getInputCols(), s.getOutputCols()):
                labels[out], source[out] = labels[name], source[name]
    x: list[Column] = []
    for name in assembler.getInputCols():
        if name in labels:
            x += [F.coalesce((c(source[name]) == F.lit(v)).cast("double"), F.lit(0.0)) for v in labels[name]]
        else:
            x.append(c(name))
    return x


def probability_of(spark: SparkSession, model: Transformer, x: list[Column], stages: list[int] | None = None) -> list[Column]:
    """Probability of class 1 over the vector components ``x``; several for the first trees of an ensemble."""
    if isinstance(model, LogisticRegressionModel):
        z = F.lit(float(model.intercept))
        for w, v in zip(model.coefficients.toArray().tolist(), x):
            z = z + F.lit(w) * v
        return [1 / (1 + F.exp(-z))]
    return ensemble_probabilities(read_ensemble(spark, model), x, stages)


@dataclass(frozen=True)
class CompiledScorer:
    """A fitted pipeline as two projections: its preparation, and the probability over the prepared columns."""

    preparation: list[SQLTransformer] = field(repr=False)
    probability: Column = field(repr=False)
    features: list[str]
    name: str = "compiled"

    def apply(self, df: DataFrame) -> DataFrame:
        out = df
        for stage in self.preparation:
            out = stage.transform(out)
        return out.withColumn("__p", self.probability).withColumn("__class", (F.col("__p") >= 0.5).cast("int"))


def compile_pipeline(spark: SparkSession, pipeline: PipelineModel, features: list[str], name: str = "compiled") -> CompiledScorer:
    """A pipeline of ``plans.training`` as a scorer without ml stages."""
    *stages, model = pipeline.stages
    (p,) = probability_of(spark, model, _inputs(stages))
    return CompiledScorer([s for s in stages if isinstance(s, SQLTransformer)], p, features, name)
