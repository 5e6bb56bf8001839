"""Weight of evidence, information value and the binning behind them."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c, nan_to_null
from riskloom.functions.order_stats import order_statistics
from riskloom.functions.joins import Lookup, freeze
from riskloom.functions.packed import PackedMaps
from riskloom.operators.encode import filled

MIN_IV = 0.02  # fixed value
SURELY_MANY = 20  # a sketch that finds so many times the limit is not wrong about it
EMPTY_CELL = 0.5  # fixed value: count used for an empty class in a bin
IV_BANDS = ((0.02, "none"), (0.1, "weak"), (0.3, "medium"))  # fixed values: upper bounds, else strong


@dataclass(frozen=True)
class RankEdges:
    """Last (value, key) of every bin but the highest; ties on value are split by key."""

    edges: tuple[tuple[Any, Any], ...]

    def bin_of(self, value: Column, key: Column) -> Column:
        above = [((value > F.lit(v)) | ((value == F.lit(v)) & (key > F.lit(k)))).cast("int") for v, k in self.edges]
        return F.when(value.isNotNull(), sum(above, F.lit(1)))


@dataclass(frozen=True)
class WidthEdges:
    """Equal-width bins, closed on the right."""

    lo: float
    hi: float
    bins: int

    def bin_of(self, value: Column, key: Column | None = None) -> Column:
        width = (self.hi - self.lo) / self.bins
        at = F.ceil((value - F.lit(self.lo)) / F.lit(width)) if width else F.lit(1)
        return F.when(value.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(self.bins), at)).cast("int"))


def rank_edges(df: DataFrame, features: list[str], key: str, bins: int) -> dict[str, RankEdges]:
    """Quantile edges of the first-come rank per feature: bin b ends at rank ``1 + b*(n-1) div bins``.

    Edges of all features are found by counting in the same rounds: first the values at the wanted ranks, then how many rows lie below and at each, and
    only where a bin ends inside rows of one value, the key at the remaining position among them.
    """
    v = {n: f"__v{i}" for i, n in enumerate(features)}
    rows = nan_to_null(df.select(*[c(n).cast("double").alias(v[n]) for n in features], c(key).alias("__key")))
    sizes = rows.agg(*[F.count(v[n]).alias(v[n]) for n in features]).first()
    ranks = {n: sorted({1 + b * (sizes[v[n]] - 1) // bins for b in range(1, bins)}) if sizes[v[n]] else [] for n in features}
    values = order_statistics(rows, {v[n]: ranks[n] for n in features if ranks[n]})
    at = [(n, x) for n in features for x in sorted(set(values.get(v[n], {}).values()))]
    if not at:
        return {n: RankEdges(()) for n in features}
    counts = rows.agg(*[e for i, (n, x) in enumerate(at) for e in (
        F.count_if(c(v[n]) < F.lit(x)).alias(f"lt{i}"), F.count_if(c(v[n]) == F.lit(x)).alias(f"eq{i}"),
        F.max(F.when(c(v[n]) == F.lit(x), F.col("__key"))).alias(f"top{i}"))]).first()
    inside = {i: sorted({r - counts[f"lt{i}"] for r in ranks[n] if values[v[n]][r] == x}) for i, (n, x) in enumerate(at)}
    split = {i: [p for p in places if p < counts[f"eq{i}"]] for i, places in inside.items()}  # a bin that takes all rows of its value ends at their last key
    ties = rows.select(*[F.when(c(v[at[i][0]]) == F.lit(at[i][1]), F.col("__key")).alias(f"k{i}") for i, places in split.items() if places])
    keys = order_statistics(ties, {f"k{i}": places for i, places in split.items() if places}) if ties.columns else {}
    edges: dict[str, list] = {n: [] for n in features}
    for i, (n, x) in enumerate(at):
        edges[n] += [(x, counts[f"top{i}"] if p == counts[f"eq{i}"] else keys[f"k{i}"][p]) for p in inside[i]]
    return {n: RankEdges(tuple(e)) for n, e in edges.items()}


def width_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, WidthEdges | None]:
    """Equal-width edges of all features from one aggregate."""
    rows = nan_to_null(df.select(*[c(n).cast("double").alias(n) for n in features]))
    row = rows.agg(*[F.struct(F.min(c(n)).alias("lo"), F.max(c(n)).alias("hi")).alias(n) for n in features]).first()
    return {n: None if row[n]["lo"] is None else WidthEdges(row[n]["lo"], row[n]["hi"], bins) for n in features}


def many_valued(df: DataFrame, features: list[str], limit: int) -> list[str]:
    """Features with more than ``limit`` distinct values, a missing one counted as a value.

    A sketch settles all that have clearly more; only the others are counted exactly, and those have few values.
    """
    filled = {n: F.coalesce(c(n).cast("double"), F.lit(float("nan"))) for n in features}
    near = df.agg(*[F.approx_count_distinct(filled[n]).alias(n) for n in features]).first()
    few = [n for n in features if near[n] <= SURELY_MANY * (limit + 1)]
    exact = df.agg(*[F.count_distinct(filled[n]).alias(n) for n in few]).first() if few else {}
    return [n for n in features if n not in few or exact[n] > limit]


def bin_counts(df: DataFrame, bins: dict[str, Column], label: str) -> DataFrame:
    """``feature, bin, good, bad``: rows per bin and class, empty classes set to one half."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), e.cast("string").alias("bin")) for n, e in bins.items()])
    y = c(label)
    counts = (df.where(y.isNotNull()).select(y.alias("y"), F.inline(pairs)).where(F.col("bin").isNotNull())
              .groupBy("feature", "bin").agg(F.count_if(F.col("y") == 0).alias("good"), F.count_if(F.col("y") == 1).alias("bad")))

    def cell(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(EMPTY_CELL)).otherwise(F.col(name).cast("double")).alias(name)

    return counts.select("feature", "bin", cell("good"), cell("bad"))


def woe_of_counts(counts: DataFrame) -> DataFrame:
    """Add ``woe`` and the bin's ``iv`` part; totals per feature come from a grouped join, not a window."""
    totals = counts.groupBy("feature").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    good, bad = F.col("good") / F.col("all_good"), F.col("bad") / F.col("all_bad")
    return (counts.join(F.broadcast(totals), "feature")  # one row per feature
            .withColumn("woe", F.ln(good / bad))
            .withColumn("iv", (good - bad) * F.col("woe"))
            .drop("all_good", "all_bad"))


def information_values(table: DataFrame) -> DataFrame:
    return table.groupBy("feature").agg(F.sum("iv").alias("iv"))


def iv_strength(iv: Column) -> Column:
    """Predictive power in words."""
    band = F
    for upper, name in IV_BANDS:
        band = band.when(iv < upper, name)
    return band.otherwise("strong")


@dataclass
class WoeModel:
    """Frozen maps: a bin table per feature plus the edges of binned numerics."""

    lookup: Lookup = field(repr=False)  # feature, bin, good, bad, woe, iv
    categorical: list[str]
    edges: dict[str, RankEdges | WidthEdges]
    key: str | None
    ivs: dict[str, float]
    maps: PackedMaps | None = field(default=None, repr=False)

    @property
    def table(self) -> DataFrame:
        return self.lookup.df

    def bin_exprs(self, schema: T.StructType) -> dict[str, Column]:
        key = c(self.key) if self.key else F.lit(None)
        out = {n: filled(n, schema[n].dataType) for n in self.categorical}
        number = {n: c(n).cast("double") for n in self.edges}
        out.update({n: e.bin_of(F.when(~F.isnan(number[n]), number[n]), key) for n, e in self.edges.items()})  # a missing number is in no bin
        return out

    def kept(self, min_iv: float = MIN_IV) -> list[str]:
        """Features whose information value reaches the threshold."""
        return [n for n in self.ivs if self.ivs[n] >= min_iv]

    def transform(self, df: DataFrame, features: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
        """Add ``<feature>_woe``; bins never seen at fit time give 0."""
        bins = self.bin_exprs(df.schema)
        features = list(bins) if features is None else features
        if self.maps is None:
            self.maps = PackedMaps(self.lookup, "feature", "bin", "woe")
        out = self.maps.attach(df, {n: bins[n].cast("string") for n in features}, {n: f"{n}_woe" for n in features})
        return out.select(*[c(k) for k in (df.columns if keep is None else keep)], *[c(f"{n}_woe") for n in features])


@dataclass(frozen=True)
class Woe:
    """Fit weight-of-evidence maps against a 0/1 label.

    Numeric features with more than ``bins`` distinct values are cut into rank
    quantiles (ties by ``key``), or into equal widths on request.
    """

    features: list[str]
    label: str
    bins: int = 5
    key: str | None = None
    numeric_method: str = "rank"

    def fit(self, df: DataFrame) -> WoeModel | None:
        """None when the label has one class only; a missing label column is an error."""
        if self.label not in df.columns:
            raise ValueError(f"Target column {self.label!r} is not in the table.")
        classes = df.agg(F.min(c(self.label)), F.max(c(self.label))).first()
        if classes[0] == classes[1]:
            return None
        features = [n for n in self.features if n in df.columns]
        numeric = [n for n in features if isinstance(df.schema[n].dataType, T.NumericType)]
        edges: dict[str, RankEdges | WidthEdges] = {}
        binned = many_valued(df, numeric, self.bins) if numeric else []
        if binned and self.numeric_method == "rank":
            if self.key is None:
                raise ValueError("rank binning needs a key column to split ties")
            edges.update(rank_edges(df, binned, self.key, self.bins))
        elif binned:
            edges.update(width_edges(df, binned, self.bins))
        model = WoeModel(Lookup(df, False), [n for n in features if n not in edges], edges, self.key, {})
        table = freeze(woe_of_counts(bin_counts(df, model.bin_exprs(df.schema), self.label)), "woe-table")
        ivs = {r["feature"]: r["iv"] for r in information_values(table.df).collect()}  # one row per feature
        return WoeModel(table, model.categorical, edges, self.key, {n: ivs[n] for n in features if n in ivs})
