"""Feature dictionary: description, transformation and information value per feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: (kind, name pattern, description, transformation); {f} = feature, {b} = name without suffix
RULES = (
    ("woe", ".*", "Weight of Evidence encoding for {b}", "WoE coding (quantile binning)"),
    ("normalized", ".*", "Log-transformed and standardized {b}", "log1p + StandardScaler"),
    ("frequency", ".*", "Frequency encoding for {b}", "Frequency encoding"),
    ("one_hot", ".*", "One-hot encoding for {f}", "One-hot encoding"),
    ("label", ".*", "Proxy binary target indicating high-risk customers (1 = high risk)", "RFM clustering (KMeans) on transaction history"),
    ("aggregate", "^Recent30_", "Recent 30-day activity: {f}", "Windowed aggregation"),
    ("aggregate", "^Velocity_", "Transaction velocity (average per {w} days)", "Rolling window calculation"),
    ("aggregate", "^TimeSinceLast_", "Recency metric: {s} days since last transaction", "Time difference aggregation"),
    ("aggregate", "^(Hour|Month)_(sin|cos)", "Cyclical encoding for temporal patterns", "sin/cos transformation"),
    ("aggregate", "^Is(Weekend|BusinessHours)_mean$", "Fraction of transactions ({b})", "Boolean aggregation"),
    ("aggregate", "^(Hour|Weekday)_", "Temporal aggregation", "Extracted from timestamp, aggregated"),
    ("aggregate", "^(Day|Month|Year)_", "Calendar component aggregation", "Extracted from timestamp, aggregated"),
    ("aggregate", "_sum$", "Sum of values", "Customer aggregation"),
    ("aggregate", "_mean$", "Mean value", "Customer aggregation"),
    ("aggregate", "_skew$", "Skewness of values", "Customer aggregation"),
    ("aggregate", ".*", "Generated feature", "See transformation details"),
)


def _fill(template: str) -> Column:
    name = F.col("Feature")
    values = {
        "{f}": name,
        "{b}": F.regexp_replace(name, "(_woe|_log_std|_freq|_mean)$", ""),
        "{w}": F.regexp_extract(name, r"_(\d+)d", 1),
        "{s}": F.substring_index(name, "_", -1),
    }
    out = F.lit(template)
    for mark, value in values.items():
        if mark in template:
            out = F.replace(out, F.lit(mark), value)
    return out


def describe_features(names: DataFrame) -> DataFrame:
    """Describe a table of ``Feature, kind`` rows by the first rule that matches."""
    description, transformation = F, F
    for kind, pattern, text, how in RULES:
        hit = (F.col("kind") == kind) & F.col("Feature").rlike(pattern)
        description = description.when(hit, _fill(text))
        transformation = transformation.when(hit, F.lit(how))
    return names.select("Feature", description.otherwise("Generated feature").alias("Description"),
                        transformation.otherwise("See transformation details").alias("Transformation"))


def feature_dictionary(spark: SparkSession, kinds: list[tuple[str, str]], ivs: dict[str, float]) -> DataFrame:
    """``Feature, Description, Transformation, IV_Value`` (IV with four decimals, empty elsewhere)."""
    names = spark.createDataFrame(kinds, "Feature string, kind string")
    values = spark.createDataFrame([(f"{n}_woe", f"{iv:.4f}") for n, iv in ivs.items()], "Feature string, iv string")
    # both sides have one row per feature
    return (describe_features(names).join(F.broadcast(values), "Feature", "left")
            .select("Feature", "Description", "Transformation", F.coalesce("iv", F.lit("")).alias("IV_Value")))
