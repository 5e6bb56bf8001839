"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
NULL_TOKEN = "__NA__"  # fixed value: name of the null bucket in encoders and WoE tables


def c(name: str) -> Column:
    """Column by its literal name (dots and dashes included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN counts as missing; Spark keeps the two apart unless told otherwise."""
    wanted = set(df.columns if cols is None else cols)
    fixes = {n: F.when(~F.isnan(c(n)), c(n)) for n in wanted if is_fractional(df, n)}
    return df.withColumns(fixes) if fixes else df


def day_floor(micros: Column) -> Column:
    """Whole days in a microsecond difference, rounded towards minus infinity."""
    day = F.lit(MICROS_PER_DAY)
    return F.round((micros - F.pmod(micros, day)) / day).cast("bigint")


def elapsed_micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def sample_skewness(x: Column) -> Column:
    """Bias-corrected (G1) skewness: null below three values, 0 for a constant group."""
    n = F.count(x).cast("double")
    corrected = F.skewness(x) * F.try_divide(F.sqrt(F.greatest(n * (n - 1), F.lit(0.0))), n - 2)
    return F.when(n < 3, None).when(F.stddev_pop(x) == 0, F.lit(0.0)).otherwise(corrected)


def row_hash(seed: int | str, keys: Iterable[str]) -> Column:
    """Hex md5 of seed and key: a reproducible random order that SQL engines share."""
    parts = [F.lit(str(seed))] + [F.coalesce(c(k).cast("string"), F.lit(NULL_TOKEN)) for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def unpivot(df: DataFrame, cols: list[str], keep: list[str] | None = None, as_type: str | None = None,
            name: str = "feature", value: str = "value") -> DataFrame:
    """Long form ``keep..., feature, value`` of the given columns."""
    as_type = as_type or df.schema[cols[0]].dataType.simpleString()
    pairs = F.array(*[F.struct(F.lit(n).alias(name), c(n).cast(as_type).alias(value)) for n in cols])
    return df.select(*[c(k) for k in (keep or [])], F.inline(pairs))
