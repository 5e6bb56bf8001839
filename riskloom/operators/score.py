"""Risk scoring of request records: validation, probability, bands and checks.

The same functions serve batch tables and streams: every step is a projection,
so a record is scored where it is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.plans.compiled import CompiledScorer, compile_pipeline
from riskloom.sources.tables import requests_from_wide

# fixed values: advice per category
RECOMMENDATIONS = {
    "LOW": "Approve - Low risk of default",
    "MEDIUM": "Review - Moderate risk, consider additional verification",
    "HIGH": "Reject - High risk of default",
}
DEFAULT_RECOMMENDATION = "Review required"
# fixed values: beginnings of the error texts
MISSING_FEATURES = "Missing required features: "
EMPTY_FEATURES = "Input contains NaN values for features: "
RESPONSE_FIELDS = ("probability", "predicted_class", "risk_category", "risk_score", "recommendation", "customer_id", "model", "timestamp")


@dataclass(frozen=True)
class RiskBands:
    """Upper bounds of the categories, exclusive."""

    low_max: float = 0.33
    medium_max: float = 0.66


def risk_category(p: Column, bands: RiskBands = RiskBands()) -> Column:
    return F.when(p < bands.low_max, "LOW").when(p < bands.medium_max, "MEDIUM").when(p.isNotNull(), "HIGH")


def risk_score(p: Column) -> Column:
    """0 to 100, halves to the even neighbour."""
    return F.bround(p * 100, 0).cast("int")


def recommendation(category: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for kv in RECOMMENDATIONS.items() for x in kv])
    return F.coalesce(F.element_at(texts, category), F.lit(DEFAULT_RECOMMENDATION))


class Scorer(Protocol):
    """A model with named input features; ``apply`` adds ``__p`` and ``__class``."""

    features: list[str]
    name: str

    def apply(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class LinearScorer:
    """Closed-form logistic score, compiled into the projection."""

    coefficients: dict[str, float]
    intercept: float
    name: str = "linear"

    @property
    def features(self) -> list[str]:
        return list(self.coefficients)

    def apply(self, df: DataFrame) -> DataFrame:
        z = sum((c(n) * F.lit(w) for n, w in self.coefficients.items()), F.lit(self.intercept))
        p = 1 / (1 + F.exp(-z))
        return df.withColumn("__p", p).withColumn("__class", (F.col("__p") >= 0.5).cast("int"))


@dataclass(frozen=True)
class PipelineScorer:
    """A fitted pyspark.ml pipeline with a probability column."""

    pipeline: PipelineModel = field(repr=False)
    features: list[str]
    name: str = "pipeline"

    def apply(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(df)
        return (out.withColumn("__p", vector_to_array("probability")[1])
                .withColumn("__class", (F.col("__p") >= 0.5).cast("int")))

    def compiled(self, spark: SparkSession) -> CompiledScorer:
        """The same scores as plain column expressions."""
        return compile_pipeline(spark, self.pipeline, self.features, self.name)


@dataclass(frozen=True)
class HardLabelScorer:
    """A model without probabilities: class 1 scores 100, class 0 scores 0."""

    features: list[str]
    predict: Callable[[DataFrame], Column] = field(repr=False)
    name: str = "hard-label"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__class", self.predict(df).cast("int")).withColumn("__p", F.lit(None).cast("double"))


def _names(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def check_requests(requests: DataFrame, features: list[str]) -> DataFrame:
    """Add ``error`` (null when the record can be scored) and ``extra_features``."""
    required = F.array(*[F.lit(n) for n in features])
    given = F.coalesce(F.map_keys("features"), F.array().cast("array<string>"))
    missing = F.array_except(required, given)
    empty = F.filter(required, lambda n: F.element_at("features", n).isNull() | F.isnan(F.element_at("features", n)))
    error = F.when(F.size(missing) > 0, F.concat(F.lit(MISSING_FEATURES), _names(missing)))
    error = error.when(F.size(empty) > 0, F.concat(F.lit(EMPTY_FEATURES), _names(empty)))
    if "_corrupt_record" in requests.columns:
        error = F.when(F.col("_corrupt_record").isNotNull(), F.lit("Malformed record")).otherwise(error)
    return requests.withColumns({"error": error, "extra_features": F.array_except(given, required)})


def score_requests(
    requests: DataFrame,
    scorer: Scorer,
    bands: RiskBands = RiskBands(),
    timestamp: Column | None = None,
) -> DataFrame:
    """Score ``customer_id, features`` records; records with an error keep it and have no score.

    Records that cannot be scored run through the model with zeros and are
    blanked afterwards, so the batch needs no split and no union.
    """
    checked = check_requests(requests, scorer.features)
    ok = F.col("error").isNull()
    inputs = [F.when(ok, F.element_at("features", F.lit(n))).otherwise(F.lit(0.0)).alias(n) for n in scorer.features]
    record = F.struct("customer_id", "features", "error", "extra_features").alias("__r")
    scored = scorer.apply(checked.select(record, *inputs))
    good = F.col("__r.error").isNull()
    p, klass = F.col("__p"), F.col("__class")
    category = F.coalesce(risk_category(p, bands), F.when(klass == 1, "HIGH").otherwise("LOW"))
    points = F.coalesce(risk_score(p), F.when(klass == 1, 100).otherwise(0))
    when_ok = {
        "probability": p,
        "predicted_class": klass,
        "risk_category": category,
        "risk_score": points,
        "recommendation": recommendation(category),
        "model": F.lit(scorer.name),
    }
    now = timestamp if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return scored.select(
        F.col("__r.customer_id").alias("customer_id"),
        *[F.when(good, e).alias(n) for n, e in when_ok.items()],
        now.alias("timestamp"), F.col("__r.error").alias("error"),
        F.col("__r.extra_features").alias("extra_features"), F.col("__r.features").alias("features"))


def score_wide(df: DataFrame, scorer: Scorer, id_col: str = "customer_id", bands: RiskBands = RiskBands()) -> DataFrame:
    """Score a table with one column per feature; the features are echoed as columns."""
    scored = score_requests(requests_from_wide(df, id_col), scorer, bands)
    names = [n for n in df.columns if n != id_col]
    return scored.select(*[n for n in scored.columns if n != "features"],
                         *[F.element_at("features", F.lit(n)).alias(n) for n in names])


def batch_summary(scored: DataFrame) -> DataFrame:
    """One row: records, scored, failed and mean probability."""
    ok = F.col("error").isNull()
    return scored.agg(F.count("*").alias("records"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
                      F.avg("probability").alias("avg_probability"))


def category_summary(scored: DataFrame) -> DataFrame:
    """Customers and share of all records per category."""
    total = scored.agg(F.count("*").alias("n")).scalar()
    counts = scored.where(F.col("risk_category").isNotNull()).groupBy("risk_category").agg(F.count("*").alias("customers"))
    return counts.withColumn("share", F.col("customers") / total)


def response_checks(scored: DataFrame) -> DataFrame:
    """``rule, failures`` over the scored records: required fields and value ranges."""
    rules = {f"{n} present": c(n).isNull() for n in RESPONSE_FIELDS}
    rules["probability in [0, 1]"] = ~F.col("probability").between(0.0, 1.0)
    rules["predicted_class in {0, 1}"] = ~F.col("predicted_class").isin(0, 1)
    rules["risk_score in [0, 100]"] = ~F.col("risk_score").between(0, 100)
    good = scored.where(F.col("error").isNull())
    row = [F.struct(F.lit(n).alias("rule"), F.count_if(bad).alias("failures")) for n, bad in rules.items()]
    return good.agg(F.array(*row).alias("s")).select(F.inline("s"))
