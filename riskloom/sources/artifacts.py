"""Save and reload fitted pipelines with their feature list and metadata."""

from __future__ import annotations

import platform
from datetime import datetime, timezone

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from riskloom.operators.score import PipelineScorer


class ModelNotLoadedError(RuntimeError):
    """No usable model at the given path."""


def save_model(spark: SparkSession, pipeline: PipelineModel, features: list[str], path: str, name: str = "pipeline") -> str:
    """Write ``model``, ``features`` and ``metadata`` below ``path``."""
    base = path.rstrip("/")
    pipeline.write().overwrite().save(f"{base}/model")
    spark.createDataFrame(list(enumerate(features)), "position int, feature string").coalesce(1).write.mode("overwrite").json(f"{base}/features")
    meta = (name, datetime.now(timezone.utc).isoformat(), pyspark.__version__, platform.python_version(), len(features))
    schema = "model string, saved_at string, spark_version string, python_version string, n_features int"
    spark.createDataFrame([meta], schema).coalesce(1).write.mode("overwrite").json(f"{base}/metadata")
    return base


def load_metadata(spark: SparkSession, path: str) -> dict:
    return spark.read.json(f"{path.rstrip('/')}/metadata").first().asDict()


def load_model(spark: SparkSession, path: str) -> PipelineScorer:
    """Reload a saved model as a scorer."""
    base = path.rstrip("/")
    try:
        pipeline = PipelineModel.load(f"{base}/model")
        rows = spark.read.schema("position int, feature string").json(f"{base}/features").orderBy("position").collect()
        meta = load_metadata(spark, base)
    except Exception as exc:
        raise ModelNotLoadedError(f"no model at {base}") from exc
    features = [r["feature"] for r in rows]
    if len(features) != meta["n_features"]:
        raise ModelNotLoadedError(f"model at {base} expects {meta['n_features']} features, list has {len(features)}")
    return PipelineScorer(pipeline, features, f"{meta['model']}:{base}")
