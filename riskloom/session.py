"""Session helpers: configuration, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions that keep a full-size exchange near 128 MiB each; adaptive execution merges small ones."""
    return max(200, min(200_000, input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(app: str = "riskloom", master: str | None = None, input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC time.

    Pass the size of the input to size the exchanges for it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, val in settings.items():
        builder = builder.config(key, val)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Wall-clock timestamps are read as UTC, so no hour is lost to daylight saving."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A single-process master (``local``, ``local[n]``) may go without the setting
    and gets a temporary folder; elsewhere a missing setting is an error, since a
    machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _LOCAL_DIR
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="riskloom-")
        atexit.register(shutil.rmtree, _LOCAL_DIR, ignore_errors=True)
    return _LOCAL_DIR


_LOCAL_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table below :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and continue from the files.

    Later fits then scan only the columns they need, and a lost executor costs
    a re-read instead of the work that led here.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="riskloom-package-")) / "riskloom-package.zip"  # the driver serves it to all executors
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
