"""Profiling queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.base import TXN_ORDERS_SEGMENT, dates_as_text, query, rounded
from riskloom.functions.order_stats import exact_quantiles
from riskloom.operators import profile as P
from riskloom.operators.clean import impute_medians, impute_missing_text
from riskloom.operators.correlation import correlation_matrix
from riskloom.sources.transactions import txn_orders


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing values put in by value, so that the imputation reports have work."""
    txn = txn_orders(spark, sf_dir, with_segment=True)
    return txn.select(
        "TransactionId", "CustomerId",
        F.when(F.col("Amount") >= 50000, F.col("Amount")).alias("Amount"),
        F.when(F.col("Amount") < 300000, F.col("Amount")).alias("Value"),
        "ProductCategory",
        F.nullif("ProviderId", F.lit("BUILDING")).alias("ProviderId"),
        F.when(F.col("ProductCategory") == "1-URGENT", F.col("ChannelId")).alias("ChannelId"))


GAPS = f"""WITH {TXN_ORDERS_SEGMENT}, gaps AS (
  SELECT TransactionId, CustomerId, CASE WHEN Amount >= 50000 THEN Amount END AS Amount,
         CASE WHEN Amount < 300000 THEN Amount END AS "Value", ProductCategory,
         CASE WHEN ProviderId <> 'BUILDING' THEN ProviderId END AS ProviderId,
         CASE WHEN ProductCategory = '1-URGENT' THEN ChannelId END AS ChannelId
  FROM txn)"""

_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", count(*) - count(\"{n}\") AS Missing, round_even((count(*) - count(\"{n}\")) * 100.0 / count(*), 1) AS Percent FROM gaps"
    for n in ("TransactionId", "CustomerId", "Amount", "Value", "ProductCategory", "ProviderId", "ChannelId"))


_ADVICE = " ".join(f"WHEN '{k}' THEN '" + v.replace("'", "''") + "'" for k, v in P.SUGGESTION_TEXT.items())


@query("""SELECT 'rows' AS item, count(*) AS n FROM orders
UNION ALL SELECT 'columns', 6 UNION ALL SELECT 'dtype bigint', 2 UNION ALL SELECT 'dtype string', 2
UNION ALL SELECT 'dtype double', 1 UNION ALL SELECT 'dtype timestamp_ntz', 1""")
def overview(spark, sf_dir):
    """Rows, columns and type histogram."""
    info = P.overview(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderkey"])
    rows = [("rows", info["rows"]), ("columns", info["columns"])] + [(f"dtype {t}", n) for t, n in info["dtypes"].items()]
    return spark.createDataFrame(rows, "item string, n bigint")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice + 1e-9, 4) + 0.0 AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 3""")
def preview(spark, sf_dir):
    """First three rows by key."""
    return rounded(dates_as_text(P.preview(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderkey"])))


@query("\nUNION ALL\n".join(f"""SELECT '{n}' AS "column", count({n}) AS count, round(avg({n}) + 1e-9, 4) + 0.0 AS mean, round(stddev_samp({n}) + 1e-9, 4) + 0.0 AS std,
  round(min({n}) + 1e-9, 4) + 0.0 AS min, round(quantile_cont({n}::DOUBLE, 0.25) + 1e-9, 4) + 0.0 AS p25, round(quantile_cont({n}::DOUBLE, 0.5) + 1e-9, 4) + 0.0 AS p50,
  round(quantile_cont({n}::DOUBLE, 0.75) + 1e-9, 4) + 0.0 AS p75, round(max({n}) + 1e-9, 4) + 0.0 AS max FROM lineitem"""
                            for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")))
def describe(spark, sf_dir):
    """Summary statistics of numeric columns with exact quartiles."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(P.describe(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]))


@query("\nUNION ALL\n".join(f"""SELECT '{n}' AS feature, round(quantile_cont({n}::DOUBLE, 0.25) + 1e-9, 4) + 0.0 AS p25,
  round(quantile_cont({n}::DOUBLE, 0.5) + 1e-9, 4) + 0.0 AS p50, round(quantile_cont({n}::DOUBLE, 0.99) + 1e-9, 4) + 0.0 AS p99 FROM lineitem"""
                            for n in ("l_quantity", "l_extendedprice", "l_discount")))
def quantiles_by_counting(spark, sf_dir):
    """Exact quantiles by rounds of counting, the way of tables too large for one aggregate."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    found = exact_quantiles(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), names, [0.25, 0.5, 0.99], one_pass_values=0, collect_limit=200)
    return rounded(spark.createDataFrame([(n, *found[n]) for n in names], "feature string, p25 double, p50 double, p99 double"))


@query("""WITH v AS (SELECT 'o_orderpriority' AS f, o_orderpriority AS v FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders),
n AS (SELECT f, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY f, v),
r AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY n DESC, v) AS r FROM n)
SELECT f AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", max(CASE WHEN r = 1 THEN v END) AS top,
       max(CASE WHEN r = 1 THEN n END) AS freq FROM r GROUP BY f""")
def describe_text(spark, sf_dir):
    """count, unique, top and freq of text columns."""
    return rounded(P.describe_text(spark.read.parquet(f"{sf_dir}/orders.parquet")))


@query(GAPS + f""", m AS ({_COUNTS}),
d AS (SELECT 'Amount' AS "column", count(DISTINCT Amount) AS Nunique FROM gaps UNION ALL SELECT 'Value', count(DISTINCT "Value") FROM gaps
      UNION ALL SELECT 'ProviderId', count(DISTINCT ProviderId) FROM gaps UNION ALL SELECT 'ChannelId', count(DISTINCT ChannelId) FROM gaps),
s AS (SELECT 'Amount' AS "column", array_to_string(list_sort(list(DISTINCT Amount))[1:3], ',') AS Sample FROM gaps WHERE Amount IS NOT NULL
      UNION ALL SELECT 'Value', array_to_string(list_sort(list(DISTINCT "Value"))[1:3], ',') FROM gaps WHERE "Value" IS NOT NULL
      UNION ALL SELECT 'ProviderId' AS "column", array_to_string(list_sort(list(DISTINCT ProviderId))[1:3], ',') AS Sample FROM gaps WHERE ProviderId IS NOT NULL
      UNION ALL SELECT 'ChannelId', array_to_string(list_sort(list(DISTINCT ChannelId))[1:3], ',') FROM gaps WHERE ChannelId IS NOT NULL),
a AS (SELECT m."column", m.Missing, m.Percent, CASE WHEN m."column" IN ('Amount', 'Value') THEN 'double' ELSE 'string' END AS Dtype, d.Nunique, s.Sample,
  CASE WHEN m."column" IN ('Amount', 'Value') THEN CASE WHEN Percent <= 5 THEN 'median' WHEN Percent <= 30 THEN 'median_or_model' ELSE 'consider_drop_or_model' END
       ELSE CASE WHEN Percent <= 20 THEN 'mode' WHEN Percent <= 50 THEN 'mode_with_flag' ELSE 'consider_drop_or_new_category' END END AS Suggestion
FROM m JOIN d USING ("column") LEFT JOIN s USING ("column") WHERE m.Missing > 0)
SELECT *, CASE Suggestion """+_ADVICE+""" END AS Suggestion_Explanation FROM a""")
def missing_table(spark, sf_dir):
    """Missing-value diagnostics with imputation advice."""
    table = P.missing_table(orders_with_gaps(spark, sf_dir))
    return table.withColumn("Sample", F.array_join("Sample", ","))


@query(GAPS + f", m AS ({_COUNTS}) SELECT * FROM m WHERE Missing > 0 ORDER BY Missing DESC, \"column\" LIMIT 5")
def missing_top(spark, sf_dir):
    """Five columns with most missing values."""
    return P.top_missing(orders_with_gaps(spark, sf_dir))


@query(GAPS + f", m AS ({_COUNTS}) SELECT \"column\", Missing AS RawMissing, CAST(0 AS BIGINT) AS ProcMissing FROM m WHERE Missing > 0")
def missing_before_after(spark, sf_dir):
    """Missing counts before and after imputation."""
    raw = orders_with_gaps(spark, sf_dir)
    return P.missing_before_after(raw, impute_missing_text(impute_medians(raw)))


def _hist_sql(table: str, col: str, bins: int) -> str:
    return f"""SELECT '{col}' AS feature, b.bin, round(lo + b.bin * (hi - lo) / {bins} + 1e-9, 4) + 0.0 AS lo, round(lo + (b.bin + 1) * (hi - lo) / {bins} + 1e-9, 4) + 0.0 AS hi,
  (SELECT count(*) FROM {table} t WHERE least(CAST(floor(({col} - s.lo) / ((s.hi - s.lo) / {bins})) AS BIGINT), {bins - 1}) = b.bin) AS n
FROM (SELECT min({col}) AS lo, max({col}) AS hi FROM {table}) s, (SELECT range AS bin FROM range({bins})) b"""


@query(_hist_sql("lineitem", "l_extendedprice", 30) + "\nUNION ALL\n" + _hist_sql("lineitem", "l_quantity", 30))
def histogram(spark, sf_dir):
    """30 equal-width bins per numeric column."""
    return rounded(P.histogram(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_extendedprice", "l_quantity"], 30))


@query("""WITH v AS (SELECT 'o_orderpriority' AS feature, o_orderpriority AS value FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders
  UNION ALL SELECT 'p_brand', p_brand FROM orders, (SELECT NULL AS p_brand WHERE false))
SELECT feature, value, count(*) AS n FROM v GROUP BY 1, 2""")
def category_counts(spark, sf_dir):
    """Value counts of text columns with at most 15 values."""
    return P.category_counts(spark.read.parquet(f"{sf_dir}/orders.parquet"))


@query("""SELECT 'p_brand' AS feature, p_brand AS value, count(*) AS n FROM part GROUP BY p_brand
UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type""")
def value_counts(spark, sf_dir):
    """Value counts of chosen columns, most frequent first, whatever their cardinality."""
    return P.category_counts(spark.read.parquet(f"{sf_dir}/part.parquet"), ["p_brand", "p_type"], max_unique=None)


_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("\nUNION ALL\n".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}) + 1e-9, 4) + 0.0 AS corr FROM lineitem" for a in _NUM for b in _NUM))
def correlation(spark, sf_dir):
    """Pearson matrix in long form."""
    return rounded(correlation_matrix(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), list(_NUM)))


@query("\nUNION ALL\n".join(f"""(WITH q AS (SELECT quantile_cont({n}, 0.25) AS q1, quantile_cont({n}, 0.5) AS q2, quantile_cont({n}, 0.75) AS q3 FROM lineitem),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT '{n}' AS "column", round(any_value(q1) + 1e-9, 4) + 0.0 AS q1, round(any_value(q2) + 1e-9, 4) + 0.0 AS median, round(any_value(q3) + 1e-9, 4) + 0.0 AS q3,
  round(min(CASE WHEN {n} >= lo THEN {n} END) + 1e-9, 4) + 0.0 AS whisker_low, round(max(CASE WHEN {n} <= hi THEN {n} END) + 1e-9, 4) + 0.0 AS whisker_high,
  count(CASE WHEN {n} < lo OR {n} > hi THEN 1 END) AS outliers FROM lineitem, f)""" for n in ("l_extendedprice", "l_discount")))
def boxplot_stats(spark, sf_dir):
    """Quartiles, whiskers and outlier counts."""
    return rounded(P.boxplot_stats(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_extendedprice", "l_discount"]))


@query("""WITH v AS (SELECT 'l_returnflag' AS f, l_returnflag AS v FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem),
n AS (SELECT f, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY f, v),
r AS (SELECT *, sum(n) OVER (PARTITION BY f) AS t, row_number() OVER (PARTITION BY f ORDER BY n DESC, v) AS r FROM n)
SELECT f AS "column", v AS top_value, round(n / t + 1e-9, 4) + 0.0 AS top_share FROM r WHERE r = 1 AND n / t >= 0.5""")
def concentration(spark, sf_dir):
    """Text columns dominated by one value."""
    return rounded(P.concentration(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_returnflag", "l_linestatus"]))


@query("""WITH s AS (SELECT user_id, value FROM events), m AS (SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(user_id) AS um, stddev_pop(user_id) AS us FROM s),
o AS (SELECT 'value' AS "column", count(CASE WHEN abs((value - vm) / vs) > 3 THEN 1 END) AS OutlierCount FROM s, m
 UNION ALL SELECT 'user_id', count(CASE WHEN abs((user_id - um) / us) > 3 THEN 1 END) FROM s, m)
SELECT * FROM o WHERE OutlierCount > 0""")
def zscore_outliers(spark, sf_dir):
    """Values beyond three population deviations."""
    return P.zscore_outliers(spark.read.parquet(f"{sf_dir}/events.parquet"), ["value", "user_id"])


@query("""WITH x AS (SELECT l_quantity AS q, l_extendedprice AS p, l_extendedprice * (1 - l_discount) AS net, l_discount AS d FROM lineitem),
c AS (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(q, p) AS corr FROM x UNION ALL SELECT 'l_quantity', 'net', corr(q, net) FROM x
 UNION ALL SELECT 'l_extendedprice', 'net', corr(p, net) FROM x UNION ALL SELECT 'l_quantity', 'l_discount', corr(q, d) FROM x
 UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(p, d) FROM x UNION ALL SELECT 'net', 'l_discount', corr(net, d) FROM x)
SELECT a, b, round(corr + 1e-9, 4) + 0.0 AS corr FROM c WHERE abs(corr) >= 0.7""")
def strong_pairs(spark, sf_dir):
    """Column pairs with |r| of at least 0.7."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), "l_discount")
    return rounded(P.strong_pairs(lines))


@query("""WITH u AS (SELECT 'p_name' AS "column", count(DISTINCT p_name) AS Nunique FROM part UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
  UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part)
SELECT *, 'high' AS side FROM (SELECT * FROM u ORDER BY Nunique DESC, "column" LIMIT 3)
UNION ALL SELECT *, 'low' FROM (SELECT * FROM u ORDER BY Nunique, "column" LIMIT 3)""")
def cardinality(spark, sf_dir):
    """Columns with most and fewest distinct values."""
    return P.cardinality_extremes(spark.read.parquet(f"{sf_dir}/part.parquet"))


@query("\nUNION ALL\n".join(f"SELECT '{n}' AS \"column\", round(var_samp({n}) + 1e-9, 4) + 0.0 AS variance FROM lineitem" for n in (*_NUM, "l_linenumber")))
def top_variance(spark, sf_dir):
    """Columns with the largest variance."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(P.top_variance(lines, [*_NUM, "l_linenumber"]))


@query("""WITH x AS (SELECT l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS net FROM lineitem)
SELECT * FROM (SELECT 'net' AS a, 'l_extendedprice' AS b, round(corr(net, l_extendedprice) + 1e-9, 4) + 0.0 AS corr FROM x
 WHERE (SELECT var_samp(net) > var_samp(l_extendedprice) FROM x)
 UNION ALL SELECT 'l_extendedprice', 'net', round(corr(net, l_extendedprice) + 1e-9, 4) + 0.0 FROM x WHERE (SELECT var_samp(net) <= var_samp(l_extendedprice) FROM x))
WHERE abs(corr) > 0.8""")
def strong_pairs_of_variable(spark, sf_dir):
    """Strong pairs among the two most variable columns."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_quantity", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    return rounded(P.strong_pairs_of_most_variable(lines, k=2))


@query("""SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_time,
  count(DISTINCT user_id) AS customers FROM events""")
def date_range(spark, sf_dir):
    """First and last time, distinct customers."""
    table = P.date_range(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", "user_id")
    fmt = "yyyy-MM-dd HH:mm:ss"
    return table.select(F.date_format("first_time", fmt).alias("first_time"), F.date_format("last_time", fmt).alias("last_time"), "customers")
