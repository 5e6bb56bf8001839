"""An append-only log of training runs that a repeated or broken append cannot spoil.

Rows are staged in a folder of their own under the id of the append, and one marker row in ``commits`` publishes them. Readers see published appends only. An append
whose marker is there changes nothing; one that was lost before its marker stages its rows anew, over the old ones. The id is by default the fingerprint of
the rows, so the same log is never in the table twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.metrics import fingerprint

LOG_SCHEMA = "run_id string, kind string, key string, value string"
COMMIT_SCHEMA = "append_id string, rows long, fingerprint string"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """append_id, rows, fingerprint: the published appends."""
    return _table(spark, f"{path.rstrip('/')}/commits", COMMIT_SCHEMA).distinct()


def stage_rows(log: DataFrame, path: str, append_id: str) -> str:
    """Write the rows of one append, in place of what an earlier attempt left."""
    target = f"{path.rstrip('/')}/rows/append_id={append_id}"
    log.write.mode("overwrite").parquet(target)
    return target


def append_run_log(log: DataFrame, path: str, append_id: str | None = None) -> bool:
    """Publish the rows of ``log``; False when this append was there already."""
    spark, base = log.sparkSession, path.rstrip("/")
    n, own = fingerprint(log).first()
    append_id = append_id or own
    if commits(spark, base).where(F.col("append_id") == append_id).limit(1).count():
        return False
    staged = spark.read.schema(log.schema).parquet(stage_rows(log, base, append_id))
    kept = fingerprint(staged).first()
    if (kept["rows"], kept["data_hash"]) != (n, own):
        raise OSError(f"append {append_id}: {kept['rows']} rows were staged of {n}")
    # one task, one file: the marker is there or not
    spark.createDataFrame([(append_id, n, own)], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/commits")
    return True


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all published appends, with their ``append_id``."""
    base = path.rstrip("/")
    rows = _table(spark, f"{base}/rows", f"{LOG_SCHEMA}, append_id string")
    return rows.join(commits(spark, base).select("append_id"), "append_id", "left_semi")
