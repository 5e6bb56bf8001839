"""Cleaning steps for raw transaction tables, and a configurable sequence of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c, nan_to_null, numeric_columns, string_columns
from riskloom.functions.order_stats import dense_codes, exact_quantiles, with_codes
from riskloom.operators.profile import column_value_counts, few_valued
from riskloom.session import materialize

SENTINELS = ("", "NA", "N/A", "Unknown", "None")  # fixed values


@dataclass(frozen=True)
class CleanConfig:
    sentinels: tuple[str, ...] = SENTINELS
    date_columns: tuple[str, ...] = ()
    drop_null_share: float = 0.8
    one_hot_max_unique: int = 10
    target: Callable[[DataFrame], Column] | None = None
    keep: tuple[str, ...] = field(default=())  # text columns that are not encoded, such as the key


def blank_sentinels(df: DataFrame, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """Text values that stand for "missing" become null (exact match)."""
    texts = string_columns(df)
    if not sentinels or not texts:
        return df
    return df.withColumns({n: F.when(~c(n).isin(*sentinels), c(n)) for n in texts})


def parse_dates(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Listed columns to timestamps; what does not parse is null."""
    present = [n for n in cols if n in df.columns]
    return df.withColumns({n: F.try_to_timestamp(c(n).cast("string")) for n in present}) if present else df


def sparse_columns(df: DataFrame, max_null_share: float = 0.8) -> list[str]:
    """Columns whose null share exceeds the limit (one aggregate)."""
    shares = nan_to_null(df).agg(*[F.avg(c(n).isNull().cast("int")).alias(n) for n in df.columns]).first().asDict()
    return [n for n in df.columns if (shares[n] or 0.0) > max_null_share]


def drop_sparse_columns(df: DataFrame, max_null_share: float = 0.8) -> DataFrame:
    gone = set(sparse_columns(df, max_null_share))
    return df.select(*[c(n) for n in df.columns if n not in gone])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Copies of one row collapse on the map side before the exchange."""
    return df.dropDuplicates()


def impute_medians(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric nulls and NaNs to the exact (interpolated) median of the column."""
    cols = cols if cols is not None else numeric_columns(df)
    df = nan_to_null(df, cols)
    if not cols:
        return df
    nulls = df.agg(*[F.count_if(c(n).isNull()).alias(n) for n in cols]).first().asDict()
    holes = [n for n in cols if nulls[n]]
    medians = exact_quantiles(df, holes, [0.5])
    fills = {n: F.coalesce(c(n).cast("double"), F.lit(medians[n][0])) for n in holes if medians[n][0] is not None}
    return df.withColumns(fills) if fills else df


def impute_missing_text(df: DataFrame, token: str = "Missing") -> DataFrame:
    texts = string_columns(df)
    return df.withColumns({n: F.coalesce(c(n), F.lit(token)) for n in texts}) if texts else df


def one_hot_columns(df: DataFrame, values: dict[str, list[str]]) -> dict[str, Column]:
    """0/1 columns named ``column_value``."""
    return {f"{n}_{v}": F.coalesce((c(n) == F.lit(v)).cast("int"), F.lit(0)) for n, vs in values.items() for v in vs}


def bounded_distincts(df: DataFrame, cols: list[str], limit: int) -> dict[str, list[str] | None]:
    """Sorted distinct values of each column, or None where there are more than ``limit``."""
    found: dict[str, list[str] | None] = {n: None for n in cols}
    cols = few_valued(df, cols, limit)
    if not cols:
        return found
    counts = column_value_counts(df, cols).where(F.col("value").isNotNull())
    few = counts.groupBy("feature").agg(F.count("*").alias("u")).where(F.col("u") <= limit)
    rows = counts.join(F.broadcast(few), "feature", "left_semi").select("feature", "value").collect()  # <= limit per column
    for r in rows:
        found[r["feature"]] = (found[r["feature"]] or []) + [r["value"]]
    return {n: sorted(v) if v is not None else None for n, v in found.items()}


def encode_text(df: DataFrame, one_hot_max_unique: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """Few values: 0/1 columns replace the original. Many: a ``_code`` column joins it."""
    texts = [n for n in string_columns(df) if n not in keep]
    distincts = bounded_distincts(df, texts, one_hot_max_unique)
    few = {n: v for n, v in distincts.items() if v is not None}
    out = df
    for n in texts:
        if n not in few:
            out = with_codes(out, n, f"{n}_code", dense_codes(df, n))
    hot = one_hot_columns(out, few)
    return out.select(*[c(n) for n in out.columns if n not in few], *[e.alias(a) for a, e in hot.items()])


def clean(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Sentinels, dates, sparse columns, copies, imputation, encoding, optional target.

    The rows are written once after the copies are gone, so the fits that follow
    (medians, distinct values, codes) read single columns instead of repeating
    the full-row exchange.
    """
    out = blank_sentinels(df, cfg.sentinels)
    out = parse_dates(out, cfg.date_columns)
    out = drop_sparse_columns(out, cfg.drop_null_share)
    out = materialize(drop_duplicate_rows(out), "clean-rows")
    out = impute_missing_text(impute_medians(out))
    out = encode_text(out, cfg.one_hot_max_unique, cfg.keep)
    if cfg.target is not None:
        out = out.withColumn("target", cfg.target(out))
    return out
