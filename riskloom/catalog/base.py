"""Registration decorator and shared fragments of the check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.exprs import c
from riskloom.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TIE = 1e-9  # added before rounding here and in the check SQL, so exact halves round alike


def query(sql: str | None = None):
    """Register a function under its name; ``sql`` is the independent check."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return run

    return register


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Doubles rounded (no negative zero) and integers widened, so engines compare equal."""
    out: list[Column] = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            out.append((F.round(c(f.name).cast("double") + TIE, special.get(f.name, digits)) + 0.0).alias(f.name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(c(f.name).cast("bigint").alias(f.name))
        else:
            out.append(c(f.name))
    return df.select(*out)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss``, for comparison between engines."""
    times = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(("timestamp", "date"))]
    return df.withColumns({n: F.date_format(c(n), "yyyy-MM-dd HH:mm:ss") for n in times})


TXN_ORDERS = """txn AS (
  SELECT o_orderkey AS TransactionId, o_custkey AS CustomerId, o_totalprice AS Amount, o_totalprice AS "Value",
         o_orderdate AS ts, o_orderpriority AS ProductCategory, o_orderstatus AS ChannelId,
         CAST(o_totalprice > 490000 AS BIGINT) AS FraudResult
  FROM orders)"""

TXN_ORDERS_SEGMENT = """txn AS (
  SELECT o_orderkey AS TransactionId, o_custkey AS CustomerId, o_totalprice AS Amount, o_totalprice AS "Value",
         o_orderdate AS ts, o_orderpriority AS ProductCategory, o_orderstatus AS ChannelId, c_mktsegment AS ProviderId,
         CAST(o_totalprice > 490000 AS BIGINT) AS FraudResult
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

TXN_EVENTS = """txn AS (
  SELECT event_id AS TransactionId, user_id AS CustomerId, value AS Amount, value AS "Value", ts, event_type AS ProductCategory,
         CAST(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) = 0 AS BIGINT) AS FraudResult
  FROM events)"""

TXN_LINES = """txn AS (
  SELECT o_custkey AS CustomerId, l_extendedprice * (1 - l_discount) AS Amount, l_extendedprice AS "Value", o_orderdate AS ts,
         p_brand AS ProductCategory, l_returnflag AS ChannelId, CAST(l_suppkey AS VARCHAR) AS ProviderId,
         CAST(l_discount >= 0.09 AS BIGINT) AS FraudResult
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
