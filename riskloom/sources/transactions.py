"""Adapters that present other tables as transactions, and a synthetic generator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.joins import skew_safe_join
from riskloom.session import use_utc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn_orders(spark: SparkSession, sf_dir: str, with_segment: bool = False) -> DataFrame:
    """Orders as transactions; the join with customer is made only when its segment is wanted."""
    orders = _table(spark, sf_dir, "orders")
    cols = [
        F.col("o_orderkey").alias("TransactionId"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_totalprice").alias("Value"),
        F.col("o_orderdate").cast("timestamp").alias("TransactionStartTime"),
        F.col("o_orderpriority").alias("ProductCategory"),
        F.col("o_orderstatus").alias("ChannelId"),
        (F.col("o_totalprice") > 490000).cast("int").alias("FraudResult"),
    ]
    if with_segment:
        customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        orders = skew_safe_join(orders, customer, "o_custkey", "c_custkey")
        cols.append(F.col("c_mktsegment").alias("ProviderId"))
    return orders.select(*cols)


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions, with times of day and a label taken from ``props``."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("TransactionId"),
        F.col("user_id").alias("CustomerId"),
        F.col("value").alias("Amount"),
        F.col("value").alias("Value"),
        F.col("ts").cast("timestamp").alias("TransactionStartTime"),
        F.col("event_type").alias("ProductCategory"),
        (F.get_json_object("props", "$.k").try_cast("int") == 0).cast("int").alias("FraudResult"),
    )


def txn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions: the largest table, with a 25-value category."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_returnflag")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = skew_safe_join(skew_safe_join(lines, orders, "l_orderkey", "o_orderkey"), part, "l_partkey", "p_partkey", keys_of=lines)
    return joined.select(
        F.col("o_custkey").alias("CustomerId"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Amount"),
        F.col("l_extendedprice").alias("Value"),
        F.col("o_orderdate").cast("timestamp").alias("TransactionStartTime"),
        F.col("p_brand").alias("ProductCategory"),
        F.col("l_returnflag").alias("ChannelId"),
        F.col("l_suppkey").cast("string").alias("ProviderId"),
        (F.col("l_discount") >= 0.09).cast("int").alias("FraudResult"),
    )


@dataclass(frozen=True)
class SyntheticShape:
    """What made-up transactions look like: spread of the log-normal measures, seconds between rows, values of the categories, share of the label."""

    amount: tuple[float, float] = (3.0, 1.0)  # mean and deviation of the logarithm
    value: tuple[float, float] = (2.5, 0.8)
    start: str = "2020-06-01 08:30:00"
    seconds_apart: int = 1_800
    categories: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("ProductCategory", ("airtime", "transport", "utilities")), ("ChannelId", ("phone", "shop")), ("ProviderId", ("north", "south", "east", "west")))
    label_share: float = 0.04


def synthetic_transactions(spark: SparkSession, n: int = 1_000, customers: int = 80, seed: int = 1, shape: SyntheticShape = SyntheticShape()) -> DataFrame:
    """Transactions of ``customers`` customers in turn, made up in parallel; the same seed gives the same rows."""
    first = F.unix_micros(F.lit(shape.start).cast("timestamp"))
    measure = lambda spread, salt: F.exp(spread[0] + spread[1] * F.randn(seed + salt))
    texts = [F.get(F.array(*[F.lit(v) for v in values]), F.floor(F.rand(seed + 10 + i) * len(values)).cast("int")).alias(name) for i, (name, values) in enumerate(shape.categories)]
    return spark.range(n).select(
        F.concat(F.lit("t"), "id").alias("TransactionId"), F.concat(F.lit("c"), F.col("id") % customers).alias("CustomerId"),
        measure(shape.amount, 0).alias("Amount"), measure(shape.value, 1).alias("Value"),
        F.timestamp_micros(first + F.col("id") * (shape.seconds_apart * 1_000_000)).alias("TransactionStartTime"),
        *texts, (F.rand(seed + 2) < shape.label_share).cast("int").alias("FraudResult"))
