"""Cleaning, splitting and sink queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_ORDERS, TXN_ORDERS_SEGMENT, dates_as_text, query, rounded
from riskloom.catalog.profiling import GAPS, orders_with_gaps
from riskloom.functions.order_stats import dense_codes, with_codes
from riskloom.operators import clean as C
from riskloom.operators.split import random_split, stratified_folds, stratified_split
from riskloom.session import scratch_path
from riskloom.sources.tables import read_table, write_split, write_table
from riskloom.sources.transactions import txn_orders


def _raw_text_orders(spark, sf_dir):
    """Orders as an untyped extract: sentinel tokens and dates as text, some unreadable."""
    txn = txn_orders(spark, sf_dir, with_segment=True)
    segment = F.col("ProviderId")
    return txn.select(
        "TransactionId", "CustomerId", "ProductCategory",
        F.when(segment == "BUILDING", "NA").when(segment == "MACHINERY", "Unknown").when(segment == "FURNITURE", "").otherwise(segment).alias("ProviderId"),
        F.when(F.col("ChannelId") == "P", "not a date").otherwise(F.date_format("TransactionStartTime", "yyyy-MM-dd HH:mm:ss")).alias("When"))


@query(f"""WITH {TXN_ORDERS_SEGMENT}
SELECT TransactionId, CustomerId, ProductCategory, CASE WHEN ProviderId NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN ProviderId END AS ProviderId,
       CASE WHEN ChannelId <> 'P' THEN strftime(ts, '%Y-%m-%d') END AS "When" FROM txn""")
def sentinels_and_dates(spark, sf_dir):
    """Sentinel tokens to null, unreadable dates to null."""
    out = C.parse_dates(C.blank_sentinels(_raw_text_orders(spark, sf_dir)), ("When",))
    return out.withColumn("When", F.date_format("When", "yyyy-MM-dd"))


@query(GAPS + """SELECT TransactionId, CustomerId, round(Amount + 1e-9, 4) + 0.0 AS Amount, round("Value" + 1e-9, 4) + 0.0 AS "Value", ProductCategory, ProviderId FROM gaps""")
def drop_sparse_columns(spark, sf_dir):
    """Columns with more than 75 % nulls are dropped (ChannelId here)."""
    return rounded(C.drop_sparse_columns(orders_with_gaps(spark, sf_dir), 0.75))


@query("""SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_quantity + 1e-9, 4) + 0.0 AS l_quantity,
  round(l_extendedprice + 1e-9, 4) + 0.0 AS l_extendedprice, round(l_discount + 1e-9, 4) + 0.0 AS l_discount, round(l_tax + 1e-9, 4) + 0.0 AS l_tax,
  l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem""")
def drop_duplicate_rows(spark, sf_dir):
    """Full-row duplicates are removed: all order lines, those of small quantities once more."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(dates_as_text(C.drop_duplicate_rows(lines.unionByName(lines.where("l_quantity < 10")))))


@query(GAPS + """, m AS (SELECT median(Amount) AS a, median("Value") AS v FROM gaps)
SELECT TransactionId, round(coalesce(Amount, a) + 1e-9, 4) + 0.0 AS Amount, round(coalesce("Value", v) + 1e-9, 4) + 0.0 AS "Value" FROM gaps, m""")
def impute_medians(spark, sf_dir):
    """Numeric nulls become the column median."""
    gaps = orders_with_gaps(spark, sf_dir).select("TransactionId", "Amount", "Value")
    return rounded(C.impute_medians(gaps, ["Amount", "Value"]))


@query(GAPS + """SELECT TransactionId, coalesce(ProviderId, 'Missing') AS ProviderId, coalesce(ChannelId, 'Missing') AS ChannelId FROM gaps""")
def impute_missing_text(spark, sf_dir):
    """Text nulls become the token Missing."""
    return C.impute_missing_text(orders_with_gaps(spark, sf_dir).select("TransactionId", "ProviderId", "ChannelId"))


_STATUS = ("F", "O", "P")
_HOT = ", ".join(f"CAST(ChannelId = '{v}' AS BIGINT) AS \"ChannelId_{v}\"" for v in _STATUS)


@query(f"WITH {TXN_ORDERS} SELECT TransactionId, {_HOT} FROM txn")
def one_hot_text(spark, sf_dir):
    """Text columns with few values become 0/1 columns."""
    return rounded(C.encode_text(txn_orders(spark, sf_dir).select("TransactionId", "ChannelId")))


@query("""SELECT p_partkey, p_type, p_name, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code, dense_rank() OVER (ORDER BY p_name) - 1 AS p_name_code FROM part""")
def category_codes(spark, sf_dir):
    """Text columns with many values get a code by sorted position."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_name")
    return rounded(C.encode_text(part, one_hot_max_unique=2))


@query("""WITH d AS (SELECT DISTINCT c_mktsegment AS v FROM customer WHERE c_mktsegment <> 'BUILDING'), k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM d)
SELECT c_custkey, coalesce(code, -1) AS code FROM customer LEFT JOIN k ON c_mktsegment = v""")
def category_codes_with_nulls(spark, sf_dir):
    """Missing values get code -1."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return rounded(with_codes(customer, "seg", "code", dense_codes(customer, "seg")).drop("seg"))


_SEGMENTS = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Missing")
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(GAPS + """, d AS (SELECT DISTINCT CustomerId, Amount, "Value", ProductCategory, ProviderId FROM gaps),
m AS (SELECT median(Amount) AS a, median("Value") AS v FROM d)
SELECT CustomerId, round(coalesce(Amount, a) + 1e-9, 4) + 0.0 AS Amount, round(coalesce("Value", v) + 1e-9, 4) + 0.0 AS "Value", """
       + ", ".join(f"CAST(ProductCategory = '{p}' AS BIGINT) AS \"ProductCategory_{p}\"" for p in _PRIORITIES) + ", "
       + ", ".join(f"CAST(coalesce(ProviderId, 'Missing') = '{s}' AS BIGINT) AS \"ProviderId_{s}\"" for s in _SEGMENTS)
       + ", CAST(CASE WHEN coalesce(Amount, a) > 400000 THEN 1 ELSE 0 END AS BIGINT) AS target FROM d, m")
def clean_table(spark, sf_dir):
    """The whole cleaning sequence with a target expression."""
    raw = orders_with_gaps(spark, sf_dir).drop("TransactionId")
    cfg = C.CleanConfig(drop_null_share=0.75, target=lambda df: F.when(F.col("Amount") > 400000, 1).otherwise(0))
    return rounded(C.clean(raw, cfg))


_ORDERED = """r AS (SELECT *, row_number() OVER (PARTITION BY {s} ORDER BY md5('42|' || o_orderkey)) AS r, count(*) OVER (PARTITION BY {s}) AS n FROM orders)"""


@query("WITH " + _ORDERED.format(s="o_orderstatus") + """
SELECT o_orderkey, o_orderstatus, CASE WHEN r <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split FROM r""")
def stratified_split_orders(spark, sf_dir):
    """20 % of every stratum, at least one row."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, "o_orderstatus", ["o_orderkey"])


@query("WITH " + _ORDERED.format(s="1") + """
SELECT o_orderkey, CASE WHEN r <= round_even(n * 0.2, 0) THEN 'test' ELSE 'train' END AS split FROM r""")
def random_split_orders(spark, sf_dir):
    """Exactly round(n * 0.2) rows of the table."""
    return random_split(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"), ["o_orderkey"])


@query("WITH " + _ORDERED.format(s="o_orderstatus") + """
SELECT o_orderkey, CASE WHEN r <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split FROM r""")
def stratified_split_in_rounds(spark, sf_dir):
    """The same split found by several rounds of counting, the way of large strata."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, "o_orderstatus", ["o_orderkey"], pivot_rows=1).select("o_orderkey", "split")


@query("WITH " + _ORDERED.format(s="(o_totalprice > 400000)") + """
SELECT o_orderkey, CAST(CASE WHEN r <= n * 1 // 5 THEN 0 WHEN r <= n * 2 // 5 THEN 1 WHEN r <= n * 3 // 5 THEN 2 WHEN r <= n * 4 // 5 THEN 3 ELSE 4 END AS BIGINT) AS fold FROM r""")
def stratified_fold_numbers(spark, sf_dir):
    """Five folds with equal class counts."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", (F.col("o_totalprice") > 400000).cast("int").alias("y"))
    return rounded(stratified_folds(orders, "y", ["o_orderkey"]).select("o_orderkey", "fold"))


_ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice + 1e-9, 4) + 0.0 AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"""


@query(_ORDERS)
def csv_round_trip(spark, sf_dir):
    """Table sink and scan by extension: csv."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = write_table(orders, scratch_path(spark, "orders") + ".csv")
    return rounded(dates_as_text(read_table(spark, path, orders.schema)))


@query(_ORDERS)
def parquet_round_trip(spark, sf_dir):
    """Table sink and scan by extension: parquet."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return rounded(dates_as_text(read_table(spark, write_table(orders, scratch_path(spark, "orders") + ".parquet"))))


@query("WITH " + _ORDERED.format(s="o_orderstatus") + """
SELECT CASE WHEN r <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM r GROUP BY 1""")
def split_sink(spark, sf_dir):
    """Train and test written by one job, read back separately."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    train, test = write_split(stratified_split(orders, "o_orderstatus", ["o_orderkey"]), scratch_path(spark, "split"))
    parts = [spark.read.parquet(p).agg(F.lit(n).alias("part"), F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
             for n, p in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


_DIRTY = f"""{TXN_ORDERS_SEGMENT}, raw AS (SELECT DISTINCT CustomerId, CASE WHEN TransactionId % 9 > 0 THEN Amount END AS Amount,
  CASE WHEN ProviderId NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN ProviderId END AS ProviderId, CASE WHEN ChannelId <> 'P' THEN strftime(ts, '%Y-%m-%d') END AS "When",
  CASE WHEN TransactionId % 5 > 0 THEN 'clerk ' || TransactionId % 37 END AS Clerk FROM txn),
codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(Clerk, 'Missing') AS v FROM raw)), med AS (SELECT median(Amount) AS a FROM raw)"""
_DIRTY_SEGMENTS = ("AUTOMOBILE", "HOUSEHOLD", "Missing")


@query(f"""WITH {_DIRTY} SELECT CustomerId, round(coalesce(Amount, a) + 1e-9, 4) + 0.0 AS Amount, "When", coalesce(Clerk, 'Missing') AS Clerk, code AS Clerk_code, """
       + ", ".join(f"CAST(coalesce(ProviderId, 'Missing') = '{v}' AS BIGINT) AS \"ProviderId_{v}\"" for v in _DIRTY_SEGMENTS)
       + """, CAST(coalesce(Amount, a) > 400000 AS BIGINT) AS target FROM raw JOIN codes ON v = coalesce(Clerk, 'Missing'), med""")
def clean_dirty_table(spark, sf_dir):
    """The whole cleaning sequence on a dirty extract: sentinels, unreadable dates, an almost empty column, copies, gaps, few and many text values."""
    key = F.col("TransactionId")
    raw = _raw_text_orders(spark, sf_dir).join(txn_orders(spark, sf_dir).select("TransactionId", "Amount"), "TransactionId").select(
        "CustomerId", F.when(key % 9 > 0, F.col("Amount")).alias("Amount"), "ProviderId", "When",
        F.when(key % 5 == 0, "N/A").otherwise(F.concat(F.lit("clerk "), (key % 37).cast("string"))).alias("Clerk"), F.when(key % 7 == 0, "note").otherwise("None").alias("Remark"))
    cfg = C.CleanConfig(date_columns=("When",), target=lambda df: F.when(F.col("Amount") > 400000, 1).otherwise(0))
    out = C.clean(raw.unionByName(raw.where("CustomerId % 3 = 0")), cfg)
    return rounded(out.withColumn("When", F.date_format("When", "yyyy-MM-dd")))
