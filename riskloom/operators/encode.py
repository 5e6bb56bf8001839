"""Encoders for customer-level categories: one-hot when few values, frequency when many."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import NULL_TOKEN, c
from riskloom.functions.joins import Lookup, freeze
from riskloom.functions.packed import PackedMaps
from riskloom.operators.profile import column_value_counts

LOW_CARDINALITY = 8  # fixed value: most distinct values, null included, that are one-hot encoded


def filled(name: str, kind: T.DataType | None = None) -> Column:
    """Category as text with the null bucket; NaN of a fractional ``kind`` is missing too."""
    value = F.when(~F.isnan(c(name)), c(name)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c(name)
    return F.coalesce(value.cast("string"), F.lit(NULL_TOKEN))


@dataclass
class CategoryEncoderModel:
    """Frozen encoder: value lists for one-hot columns, a share table for the others."""

    one_hot: dict[str, list[str]]
    frequency_cols: list[str]
    shares: Lookup | None = field(default=None, repr=False)  # feature, value, share
    maps: PackedMaps | None = field(default=None, repr=False)

    @property
    def feature_names(self) -> list[str]:
        return [f"{n}_{v}" for n, vs in self.one_hot.items() for v in vs] + [f"{n}_freq" for n in self.frequency_cols]

    def one_hot_exprs(self, schema: T.StructType) -> list[Column]:
        return [(filled(n, schema[n].dataType) == F.lit(v)).cast("int").alias(f"{n}_{v}") for n, vs in self.one_hot.items() for v in vs]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Encoded columns next to ``keep`` (default: all columns); unseen values give 0."""
        keep = df.columns if keep is None else keep
        out = df
        if self.frequency_cols:
            if self.maps is None:
                self.maps = PackedMaps(self.shares, "feature", "value", "share")
            out = self.maps.attach(df, {n: filled(n, df.schema[n].dataType) for n in self.frequency_cols}, {n: f"{n}_freq" for n in self.frequency_cols})
        return out.select(*[c(k) for k in keep], *self.one_hot_exprs(df.schema), *[c(f"{n}_freq") for n in self.frequency_cols])


def category_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """``feature, value, n, share`` with nulls counted under the null token."""
    counts = column_value_counts(df.select(*[filled(n, df.schema[n].dataType).alias(n) for n in cols]), cols)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return (counts.join(F.broadcast(totals), "feature")  # one row per column
            .select("feature", "value", "n", (F.col("n") / F.col("total")).alias("share")))


@dataclass(frozen=True)
class CategoryEncoder:
    cols: list[str]
    low_cardinality: int = LOW_CARDINALITY

    def fit(self, df: DataFrame) -> CategoryEncoderModel:
        cols = [n for n in self.cols if n in df.columns]
        if not cols:
            return CategoryEncoderModel({}, [])
        shares = freeze(category_shares(df, cols), "category-shares")
        few = shares.df.groupBy("feature").agg(F.count("*").alias("u")).where(F.col("u") <= self.low_cardinality)
        # at most low_cardinality values per column reach the driver
        rows = shares.df.join(F.broadcast(few), "feature", "left_semi").select("feature", "value").collect()
        values: dict[str, list[str]] = {}
        for r in rows:
            values.setdefault(r["feature"], []).append(r["value"])
        one_hot = {n: sorted(values[n]) for n in cols if n in values}
        many = [n for n in cols if n not in values]
        return CategoryEncoderModel(one_hot, many, shares.where(F.col("feature").isin(many)) if many else None)
