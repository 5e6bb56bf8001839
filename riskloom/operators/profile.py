"""Profiling tables: what a data-quality report shows, as small DataFrames."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c, nan_to_null, numeric_columns, string_columns, unpivot
from riskloom.functions.order_stats import exact_quantiles
from riskloom.operators.correlation import correlation_pairs

# fixed values: imputation suggestions and their explanations
SUGGESTION_TEXT = {
    "none": "No action needed",
    "median": "Impute numeric values with median",
    "median_or_model": "Impute with median or consider model-based imputation",
    "consider_drop_or_model": "Consider dropping or using model-based imputation",
    "mode": "Impute categorical values with mode",
    "mode_with_flag": "Impute with mode and add missing flag",
    "consider_drop_or_new_category": "Consider dropping column or create a new category",
}
MISSING_SCHEMA = ("column string, Missing bigint, Percent double, Dtype string, Nunique bigint, "
                  "Sample array<string>, Suggestion string, Suggestion_Explanation string")


def overview(df: DataFrame, preview_order: list[str], preview_rows: int = 3) -> dict:
    """Row and column counts, type histogram and a preview in a stated order."""
    return {
        "rows": df.count(),
        "columns": len(df.columns),
        "dtypes": dict(Counter(t for _, t in df.dtypes)),
        "preview": preview(df, preview_order, preview_rows),
    }


def preview(df: DataFrame, order: list[str], rows: int = 3) -> DataFrame:
    """First rows in a stated order; the limit is the feature (a top-k, no full sort)."""
    return df.orderBy(*[c(n) for n in order]).limit(rows)


def column_value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``feature, value, n`` of several columns from one scan and one exchange; nulls included."""
    long = unpivot(df.select(*[c(n) for n in cols]), cols, as_type="string")
    return long.groupBy("feature", "value").agg(F.count("*").alias("n"))


def few_valued(df: DataFrame, cols: list[str], limit: int) -> list[str]:
    """Columns that may have at most ``limit`` distinct values.

    A sketch of a few kilobytes per column rules out keys and free text before
    any exact count would shuffle all their values; its error is far below the
    margin of ten, so the exact count still decides every close case.
    """
    if not cols:
        return []
    row = df.agg(*[F.approx_count_distinct(c(n)).alias(n) for n in cols]).first()
    return [n for n in cols if row[n] <= 10 * limit]


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column (long, one row per column)."""
    cols = cols or numeric_columns(df)
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    stats = []
    for n in cols:
        x = c(n).cast("double")
        q = [F.lit(v).cast("double") for v in quartiles[n]]
        stats.append(F.struct(
            F.lit(n).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), F.max(x).alias("max")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, unique, top and freq per text column; ties go to the smallest value."""
    counts = column_value_counts(df, cols or string_columns(df)).where(F.col("value").isNotNull())
    sums = counts.groupBy("feature").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq"))
    # of the values that reach the largest count, the smallest; one row per column on the broadcast side
    tops = counts.join(F.broadcast(sums.select(F.col("feature").alias("__f"), "freq")), (F.col("feature") == F.col("__f")) & (F.col("n") == F.col("freq")))
    first = tops.groupBy("feature").agg(F.mode("value", deterministic=True).alias("top"))  # all as frequent: the smallest
    return sums.join(F.broadcast(first), "feature").select(F.col("feature").alias("column"), "count", "unique", "top", "freq")


def suggestion(missing: Column, percent: Column, numeric: Column) -> Column:
    """Imputation advice from the share of missing values and the kind of column."""
    for_numbers = (F.when(percent <= 5, "median").when(percent <= 30, "median_or_model").otherwise("consider_drop_or_model"))
    for_text = F.when(percent <= 20, "mode").when(percent <= 50, "mode_with_flag").otherwise("consider_drop_or_new_category")
    return F.when(missing == 0, "none").when(numeric, for_numbers).otherwise(for_text)


def explanation(code: Column) -> Column:
    pairs = [F.lit(x) for kv in SUGGESTION_TEXT.items() for x in kv]
    return F.element_at(F.create_map(*pairs), code)


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``column, Missing, Percent`` for every column, in one aggregate."""
    cols = cols or df.columns
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    missing = [F.struct(F.lit(n).alias("column"), F.count_if(c(n).isNull()).alias("Missing")) for n in cols]
    return df.agg(F.count("*").alias("rows"), F.array(*missing).alias("m")).select("rows", F.inline("m")).select(
        "column", "Missing", F.bround(F.try_divide(F.col("Missing") * 100.0, F.col("rows")), 1).alias("Percent"))


def missing_table(df: DataFrame, cols: list[str] | None = None, sample: int = 3) -> DataFrame:
    """Diagnostics of the columns that have missing values, most missing first.

    Only columns with missing values are counted further. The sample is the
    smallest distinct values, numbers by size; each map task keeps only its own first few before
    the shuffle. A table without rows gives an empty report.
    """
    found = missing_counts(df, cols).where(F.col("Missing") > 0).collect()  # one row per column
    cols = [r["column"] for r in found]
    if not cols:
        return df.sparkSession.createDataFrame([], MISSING_SCHEMA)
    report = df.sparkSession.createDataFrame(found, "column string, Missing bigint, Percent double")
    values = column_value_counts(nan_to_null(df.select(*[c(n) for n in cols])), cols).where(F.col("value").isNotNull())
    distinct = values.groupBy(F.col("feature").alias("column")).agg(F.count("*").alias("Nunique"))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    by_size = F.when(F.col("feature").isin([n for n in cols if isinstance(kinds[n], T.NumericType)]), F.col("value").try_cast("double"))
    first = values.withColumn("r", F.row_number().over(Window.partitionBy("feature").orderBy(by_size, "value"))).where(F.col("r") <= sample)
    ordered = F.array_sort(F.collect_list(F.struct("r", "value")))
    samples = first.groupBy(F.col("feature").alias("column")).agg(F.transform(ordered, lambda x: x["value"]).alias("Sample"))
    type_map = F.create_map(*[F.lit(x) for n in cols for x in (n, kinds[n].simpleString())])
    numbers = [n for n in cols if isinstance(kinds[n], T.NumericType)]
    is_number = F.col("column").isin(numbers) if numbers else F.lit(False)
    # one row per column of the table on every side
    return (report.join(F.broadcast(distinct), "column", "left").join(F.broadcast(samples), "column", "left")
            .select("column", "Missing", "Percent", F.element_at(type_map, F.col("column")).alias("Dtype"),
                    F.coalesce("Nunique", F.lit(0)).alias("Nunique"),
                    F.coalesce("Sample", F.array().cast("array<string>")).alias("Sample"),
                    suggestion(F.col("Missing"), F.col("Percent"), is_number).alias("Suggestion"))
            .withColumn("Suggestion_Explanation", explanation(F.col("Suggestion")))
            .orderBy(F.col("Missing").desc(), "column"))


def top_missing(df: DataFrame, k: int = 5) -> DataFrame:
    """The k columns with most missing values (a top-k report)."""
    return missing_counts(df).where(F.col("Missing") > 0).orderBy(F.col("Missing").desc(), "column").limit(k)


def missing_before_after(raw: DataFrame, processed: DataFrame, k: int = 20) -> DataFrame:
    """Missing counts of the raw columns next to those after processing (top-k report)."""
    before = missing_counts(raw).where(F.col("Missing") > 0).select("column", F.col("Missing").alias("RawMissing"))
    after = missing_counts(processed).select("column", F.col("Missing").alias("ProcMissing"))
    return (before.join(F.broadcast(after), "column", "left").withColumn("ProcMissing", F.coalesce("ProcMissing", F.lit(0)))
            .orderBy(F.col("RawMissing").desc(), "column").limit(k))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's minimum and maximum, last bin closed; empty bins kept."""
    cols = cols or numeric_columns(df)
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    limits = df.agg(*[F.struct(F.min(c(n)).cast("double").alias("lo"), F.max(c(n)).cast("double").alias("hi")).alias(n)
                      for n in cols]).first()
    rows, frames = [], []
    for n in cols:
        lo, hi = limits[n]["lo"], limits[n]["hi"]
        if lo is None:
            continue
        if lo == hi:  # the numpy convention for a constant column
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        at = F.least(F.floor((c(n) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        frames.append(F.struct(F.lit(n).alias("feature"), at.alias("bin")))
        rows += [(n, b, lo + b * width, lo + (b + 1) * width) for b in range(bins)]
    grid = df.sparkSession.createDataFrame(rows, "feature string, bin int, lo double, hi double")
    if not frames:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    counts = (df.select(F.inline(F.array(*frames))).where(F.col("bin").isNotNull())
              .groupBy("feature", "bin").agg(F.count("*").alias("n")))
    # at most one row per column and bin on either side
    return (grid.join(F.broadcast(counts), ["feature", "bin"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0))))


def category_counts(df: DataFrame, cols: list[str] | None = None, max_unique: int | None = 15) -> DataFrame:
    """Value counts of text columns with at most ``max_unique`` distinct values."""
    cols = cols or string_columns(df)
    if max_unique is not None:
        cols = few_valued(df, cols, max_unique)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, value string, n bigint")
    counts = column_value_counts(df, cols).where(F.col("value").isNotNull())
    if max_unique is not None:
        few = counts.groupBy("feature").agg(F.count("*").alias("u")).where(F.col("u") <= max_unique).select("feature")
        counts = counts.join(F.broadcast(few), "feature", "left_semi")  # one row per column
    return counts.orderBy("feature", F.col("n").desc(), "value")


def boxplot_stats(df: DataFrame, cols: list[str] | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers inside the fences and the number of points beyond them."""
    cols = cols or numeric_columns(df)
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    stats = []
    for n in cols:
        if quartiles[n][0] is None:
            continue
        q1, q2, q3 = quartiles[n]
        lo, hi = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        x = c(n).cast("double")
        stats.append(F.struct(
            F.lit(n).alias("column"), F.lit(q1).alias("q1"), F.lit(q2).alias("median"), F.lit(q3).alias("q3"),
            F.min(F.when(x >= F.lit(lo), x)).alias("whisker_low"), F.max(F.when(x <= F.lit(hi), x)).alias("whisker_high"),
            F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias("outliers")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def concentration(df: DataFrame, cols: list[str] | None = None, min_share: float = 0.5) -> DataFrame:
    """Columns whose most frequent value covers at least ``min_share`` of the non-null rows."""
    top = describe_text(df, cols)
    return (top.withColumn("top_share", F.col("freq") / F.col("count")).where(F.col("top_share") >= min_share)
            .select("column", F.col("top").alias("top_value"), "top_share"))


def zscore_outliers(df: DataFrame, cols: list[str] | None = None, threshold: float = 3.0, k: int | None = 5) -> DataFrame:
    """Values further than ``threshold`` population deviations from the mean, per column."""
    cols = cols or numeric_columns(df)
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    moments = df.agg(*[F.struct(F.avg(c(n)).alias("m"), F.stddev_pop(c(n)).alias("s")).alias(n) for n in cols])
    # a one-row frame, read through scalar subqueries: two passes, no collect
    counts = []
    for n in cols:
        mean = moments.select(c(n)["m"]).scalar()
        spread = moments.select(c(n)["s"]).scalar()
        z = F.abs((c(n) - mean) / F.nullif(spread, F.lit(0.0)))
        counts.append(F.struct(F.lit(n).alias("column"), F.count_if(z > threshold).alias("OutlierCount")))
    table = df.agg(F.array(*counts).alias("s")).select(F.inline("s"))
    if k is None:
        return table
    return table.where(F.col("OutlierCount") > 0).orderBy(F.col("OutlierCount").desc(), "column").limit(k)


def strong_pairs(df: DataFrame, cols: list[str] | None = None, min_abs: float = 0.7, strict: bool = False) -> DataFrame:
    """Unordered column pairs with a high absolute correlation."""
    pairs = correlation_pairs(df, cols or numeric_columns(df))
    size = F.abs("corr")
    return pairs.where(size > min_abs if strict else size >= min_abs).orderBy(size.desc(), "a", "b")


def cardinality(df: DataFrame, cols: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per text column."""
    cols = cols or string_columns(df)
    if approximate:
        row = [F.struct(F.lit(n).alias("column"), F.approx_count_distinct(c(n)).alias("Nunique")) for n in cols]
        return df.agg(F.array(*row).alias("s")).select(F.inline("s"))
    counts = column_value_counts(df, cols)
    return counts.groupBy(F.col("feature").alias("column")).agg(F.count("value").alias("Nunique"))


def cardinality_extremes(df: DataFrame, cols: list[str] | None = None, k: int = 3) -> DataFrame:
    """The k columns with most and the k with fewest distinct values (top-k report)."""
    table = cardinality(df, cols)
    high = table.orderBy(F.col("Nunique").desc(), "column").limit(k).withColumn("side", F.lit("high"))
    low = table.orderBy("Nunique", "column").limit(k).withColumn("side", F.lit("low"))
    return high.unionByName(low)


def column_variances(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or numeric_columns(df)
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    row = [F.struct(F.lit(n).alias("column"), F.var_samp(c(n)).alias("variance")) for n in cols]
    return df.agg(F.array(*row).alias("s")).select(F.inline("s"))


def top_variance(df: DataFrame, cols: list[str] | None = None, k: int = 20) -> DataFrame:
    """Columns with the largest sample variance (top-k report)."""
    return column_variances(df, cols).orderBy(F.col("variance").desc_nulls_last(), "column").limit(k)


def strong_pairs_of_most_variable(df: DataFrame, cols: list[str] | None = None, k: int = 20, min_abs: float = 0.8) -> DataFrame:
    """Highly correlated pairs among the k most variable columns."""
    chosen = [r["column"] for r in top_variance(df, cols, k).collect()]  # at most k names
    return strong_pairs(df, chosen, min_abs, strict=True)


def date_range(df: DataFrame, time_col: str, id_col: str) -> DataFrame:
    return df.agg(F.min(c(time_col)).alias("first_time"), F.max(c(time_col)).alias("last_time"),
                  F.count_distinct(c(id_col)).alias("customers"))
