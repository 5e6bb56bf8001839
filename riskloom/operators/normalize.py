"""log1p, correlation pruning and standardisation with frozen statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c, nan_to_null
from riskloom.operators.correlation import correlations

MAX_CORRELATION = 0.95  # fixed value


def log_columns(names: list[str], amount: str = "Amount", value: str = "Value") -> list[str]:
    """Aggregates that are log-scaled: measures and recent activity, spreads excluded."""
    return [n for n in names if n.startswith((amount, value, "Recent30")) and "std" not in n]


def log1p(name: str) -> Column:
    """ln(1 + x); null at or below -1."""
    return F.log1p(c(name).cast("double"))


def population_moments(df: DataFrame, exprs: dict[str, Column]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population deviation of each expression, from one aggregate."""
    if not exprs:
        return {}
    row = df.agg(*[F.struct(F.avg(e).alias("m"), F.stddev_pop(e).alias("s")).alias(n) for n, e in exprs.items()]).first()
    return {n: (row[n]["m"], row[n]["s"]) for n in exprs}


def standardized(x: Column, mean: float | None, std: float | None) -> Column:
    """(x - mean) / std; a constant column is only centred."""
    return (x - F.lit(mean).cast("double")) / F.lit(std or 1.0)


def pruned_columns(pairs: dict[tuple[str, str], float | None], cols: list[str], threshold: float = MAX_CORRELATION) -> list[str]:
    """Columns without a highly correlated earlier column, whether that one is kept or not."""
    gone = {b for (a, b), r in pairs.items() if a != b and r is not None and abs(r) > threshold}
    return [n for n in cols if n not in gone]


@dataclass(frozen=True)
class NormalizerModel:
    stats: dict[str, tuple[float | None, float | None]]

    @property
    def feature_names(self) -> list[str]:
        return [f"{n}_log_std" for n in self.stats]

    def exprs(self) -> list[Column]:
        return [standardized(log1p(n), m, s).alias(f"{n}_log_std") for n, (m, s) in self.stats.items()]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        keep = df.columns if keep is None else keep
        return df.select(*[c(k) for k in keep], *self.exprs())


@dataclass(frozen=True)
class Normalizer:
    cols: list[str]
    drop_collinear: bool = True
    max_correlation: float = MAX_CORRELATION

    def fit(self, df: DataFrame) -> NormalizerModel:
        logs = df.select(*[log1p(n).alias(n) for n in self.cols])
        kept = list(self.cols)
        if self.drop_collinear and len(kept) > 1:
            kept = pruned_columns(correlations(logs, kept), kept, self.max_correlation)
        return NormalizerModel(population_moments(nan_to_null(logs), {n: c(n) for n in kept}))
