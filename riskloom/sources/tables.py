"""Table scans and sinks, chosen by file extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c
from riskloom.session import scratch_path

REQUEST_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("features", T.MapType(T.StringType(), T.StringType())),
    T.StructField("_corrupt_record", T.StringType()),
])


def _extension(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Scan a csv, parquet or json dataset; any other extension is an error.

    Pass ``schema`` for large csv / json data: inference reads the data twice.
    """
    kind = _extension(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "csv":
        reader = reader.option("header", True)
        return (reader if schema is not None else reader.option("inferSchema", True)).csv(path)
    if kind == "parquet":
        return reader.parquet(path)
    if kind == "json":
        return reader.json(path)
    raise ValueError(f"Unsupported file extension: {kind!r}")


def write_table(df: DataFrame | None, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write csv or parquet by extension; folders are created as needed."""
    if df is None:
        raise ValueError("No table to save: process the data first.")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    kind = _extension(path)
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"Unsupported file extension: {kind!r}")
    return path


def write_features(features: DataFrame, dictionary: DataFrame, folder: str) -> tuple[str, str]:
    """Feature table and its dictionary side by side."""
    base = folder.rstrip("/")
    return (write_table(features, f"{base}/features.parquet"),
            write_table(dictionary, f"{base}/feature_dictionary.csv"))


def write_labels(labels: DataFrame, features_with_label: DataFrame, folder: str, id_col: str = "CustomerId") -> tuple[str, str]:
    """Label table (key, is_high_risk) and the analytics base table."""
    base = folder.rstrip("/")
    return (write_table(labels.select(c(id_col), "is_high_risk"), f"{base}/proxy_labels.parquet"),
            write_table(features_with_label, f"{base}/analytics_base.parquet"))


def write_split(split: DataFrame, folder: str, split_col: str = "split") -> tuple[str, str]:
    """One job writes both parts, laid out as ``split=train`` and ``split=test``."""
    base = folder.rstrip("/")
    path = write_table(split, f"{base}/split.parquet", partition_by=[split_col])
    return f"{path}/{split_col}=train", f"{path}/{split_col}=test"


def read_requests(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Prediction records ``{"customer_id": ..., "features": {name: number}}``.

    Values are read as text and cast one by one, so a bad value spoils one
    feature and not the map; malformed records stay in ``_corrupt_record``.
    """
    return (spark.read.schema(REQUEST_SCHEMA).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("multiLine", multiline).json(path))


def parse_requests(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Requests held as JSON text in a column (a message body)."""
    parsed = F.from_json(c(json_col), REQUEST_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.select(parsed.alias("r")).select("r.*")


def numeric_features(requests: DataFrame) -> DataFrame:
    """Cast the feature map to ``map<string,double>``; a value that is no number becomes null."""
    return requests.withColumn("features", F.transform_values("features", lambda _, v: v.try_cast("double")))


def requests_from_wide(df: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """One column per feature to request records; missing values leave the map.

    Without an id column, rows are numbered ``CUST_0001``... in scan order.
    """
    names = [n for n in df.columns if n != id_col]
    entries = F.array(*[F.struct(F.lit(n).alias("k"), c(n).try_cast("double").alias("v")) for n in names])
    present = F.filter(entries, lambda e: e["v"].isNotNull() & ~F.isnan(e["v"]))
    if id_col in df.columns:
        base = df.withColumn("customer_id", c(id_col).cast("string"))
    else:
        base = with_row_numbers(df, "__row").withColumn(
            "customer_id", F.concat(F.lit("CUST_"), F.lpad(F.col("__row").cast("string"), 4, "0")))
        base = base.withColumn("customer_id", F.when(F.col("__row") < 10_000, F.col("customer_id"))
                               .otherwise(F.concat(F.lit("CUST_"), F.col("__row").cast("string"))))
    return base.select("customer_id", F.map_from_entries(present).alias("features"))


def with_row_numbers(df: DataFrame, out: str) -> DataFrame:
    """Consecutive 1-based numbers in scan order, without sorting the table.

    ``monotonically_increasing_id`` holds partition and position; only the row
    count per partition is summed up. The ids are written once to the shared
    folder, because a plan evaluated twice may be partitioned differently.
    """
    path = scratch_path(df.sparkSession, "row-ids")
    df.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    tagged = df.sparkSession.read.parquet(path)
    part = F.shiftrightunsigned("__id", 33)
    sizes = tagged.groupBy(part.alias("__p")).agg(F.count("*").alias("n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__s"))  # one row per partition
    inside = F.col("__id") - F.shiftleft(F.col("__p"), 33)
    return (tagged.withColumn("__p", part).join(F.broadcast(starts), "__p")
            .withColumn(out, F.col("__s") + inside + 1).drop("__p", "__s", "__id"))
