"""Score request records as they arrive; stateless, with the batch code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.score import RiskBands, Scorer, score_requests
from riskloom.sources.tables import REQUEST_SCHEMA, numeric_features


def read_request_stream(spark: SparkSession, folder: str, max_files: int = 1_000) -> DataFrame:
    """JSON records dropped into a folder; malformed lines are kept for reporting."""
    return (spark.readStream.schema(REQUEST_SCHEMA).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("maxFilesPerTrigger", max_files).json(folder))


def score_stream(requests: DataFrame, scorer: Scorer, bands: RiskBands = RiskBands()) -> DataFrame:
    return score_requests(numeric_features(requests), scorer, bands)


def start_scoring(scored: DataFrame, out_path: str, checkpoint: str, available_now: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Append scored records as parquet; the checkpoint makes restarts exactly-once."""
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(out_path)
