"""Pearson correlation over pairwise complete rows."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c, nan_to_null

AGGREGATED_PRODUCTS = 60  # above this, generated code grows too large and vectors are faster


def _prepared(cols: list[str], stats: dict) -> dict[str, Column]:
    """Standardised values z, squares q and, where values are missing, presence marks m.

    Missing values enter as zeros, so ``sum z_a z_b`` covers exactly the rows
    where both are present, and a product with a mark restricts the other sums
    to the same rows.
    """
    out = {}
    for n in cols:
        _, mean, std, missing = stats[n]
        z = (c(n).cast("double") - F.lit(mean)) / F.lit(std)
        out[f"z{n}"] = F.coalesce(z, F.lit(0.0)) if missing else z
        out[f"q{n}"] = out[f"z{n}"] * out[f"z{n}"]
        if missing:
            out[f"m{n}"] = c(n).isNotNull().cast("double")
    return out


def _aggregated(df: DataFrame, prepared: dict[str, Column], wanted: list[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """Few products: one aggregate in generated code."""
    named = df.select(*[e.alias(n) for n, e in prepared.items()])
    row = named.agg(*[F.sum(c(a) * c(b)).alias(str(i)) for i, (a, b) in enumerate(wanted)]).first()
    return {pair: row[str(i)] for i, pair in enumerate(wanted)}


def _by_vectors(df: DataFrame, prepared: dict[str, Column], wanted: list[tuple[str, str]]) -> dict[tuple[str, str], float]:
    """Many products: the covariance of a vector column holds them all."""
    vectors = df.select(array_to_vector(F.array(*prepared.values())).alias("v"))
    summary = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()["s"]
    n, mean, std = float(summary["count"]), summary["mean"].toArray(), np.sqrt(summary["variance"].toArray())
    corr = Correlation.corr(vectors, "v").first()[0].toArray()  # columns x columns
    cov = np.nan_to_num(corr) * np.outer(std, std) * (n - 1) / n
    np.fill_diagonal(cov, std**2 * (n - 1) / n)
    sums = n * (cov + np.outer(mean, mean))
    at = {name: i for i, name in enumerate(prepared)}
    return {(a, b): sums[at[a], at[b]] for a, b in wanted}


def correlations(df: DataFrame, cols: list[str]) -> dict[tuple[str, str], float | None]:
    """Coefficient per unordered pair and of each column with itself.

    None where a side is constant on the shared rows (a constant column has no
    defined correlation, not even with itself).
    """
    pairs = list(combinations(cols, 2))
    result: dict[tuple[str, str], float | None] = dict.fromkeys(pairs)
    if not cols:
        return result
    df = nan_to_null(df.select(*[c(n) for n in cols]))
    row = df.agg(*[F.struct(F.count(c(n)).alias("n"), F.avg(c(n)).alias("m"), F.stddev_pop(c(n)).alias("s"),
                            F.count_if(c(n).isNull()).alias("missing")).alias(n) for n in cols]).first()
    stats = {n: tuple(row[n]) for n in cols}
    varying = {n for n in cols if stats[n][2]}  # not empty, not constant
    result.update({(n, n): 1.0 if n in varying else None for n in cols})
    pairs = [(x, y) for x, y in pairs if x in varying and y in varying]
    if not pairs:
        return result
    prepared = _prepared([n for n in cols if n in varying], stats)

    def parts(x: str, y: str) -> dict[str, tuple[str, str]]:
        """The products one pair needs; those without a mark are known beforehand."""
        mx, my = (f"m{n}" if f"m{n}" in prepared else None for n in (x, y))
        need = {"xy": (f"z{x}", f"z{y}"), "xx": (f"q{x}", my) if my else (f"z{x}", f"z{x}"), "yy": (f"q{y}", mx) if mx else (f"z{y}", f"z{y}")}
        if my:
            need["x"] = (f"z{x}", my)
        if mx:
            need["y"] = (f"z{y}", mx)
        if mx or my:
            need["n"] = (mx or my, my or mx)
        return need

    wanted = sorted({p for x, y in pairs for p in parts(x, y).values()})
    sums = (_aggregated if len(wanted) <= AGGREGATED_PRODUCTS else _by_vectors)(df, prepared, wanted)
    rows = float(stats[cols[0]][0] + stats[cols[0]][3])
    for x, y in pairs:
        s = {k: sums[p] for k, p in parts(x, y).items()}
        n, sx, sy = s.get("n", rows), s.get("x", 0.0), s.get("y", 0.0)
        vx, vy = n * s["xx"] - sx * sx, n * s["yy"] - sy * sy
        if n > 1 and vx > 1e-12 * n * n and vy > 1e-12 * n * n:
            r = (n * s["xy"] - sx * sy) / np.sqrt(vx * vy)
            result[x, y] = float(min(1.0, max(-1.0, r)))
    return result


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``a, b, corr`` for every unordered pair (a before b in the given order)."""
    rows = [(a, b, r) for (a, b), r in correlations(df, cols).items() if a != b]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """The full matrix in long form: both directions and the diagonal."""
    found = correlations(df, cols)
    rows = [(a, b, r) for (a, b), r in found.items()] + [(b, a, r) for (a, b), r in found.items() if a != b]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")
