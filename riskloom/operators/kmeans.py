"""k-means with several starts that advance together, repeatable in any engine.

Points are whole numbers (a coordinate times ``GRID``, rounded), so sums over any split of the rows are exact and every engine finds the same centres. The first
centres of a start are the points with the smallest md5 of start and key. Each iteration is one aggregate over all rows: every row
goes to its nearest centre of each start that still moves, and counts and coordinate sums per start and cluster come back (starts x clusters rows). A last
aggregate gives each start's cost; the cheapest start wins, the first of equals.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exprs import c, row_hash

GRID = 1_000_000  # steps per unit of a coordinate
COMPILED_ROWS = 50_000  # more rows are assigned as arrays
SPREAD_ROWS = 1_000_000  # fewer rows may come in one partition
SEED_ROWS = 64  # rows per start that the seeding reads at first
Center = tuple[float, ...]


@dataclass(frozen=True)
class KMeansFit:
    """Centres of the cheapest start in grid steps, its cost, and the iterations that any start took."""

    centers: list[Center]
    cost: float
    iterations: int


def grid_point(x: Column) -> Column:
    return F.round(x * GRID).cast("bigint")


def squared_distance(point: list[Column], center: Center) -> Column:
    parts = [(p.cast("double") - F.lit(float(m))) * (p.cast("double") - F.lit(float(m))) for p, m in zip(point, center)]
    total = parts[0]
    for more in parts[1:]:
        total = total + more
    return total


def nearest(point: list[Column], centers: list[Center]) -> Column:
    """Number of the nearest centre, the first of equals."""
    distances = F.array(*[squared_distance(point, m) for m in centers])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _sums_of_batches(points: DataFrame, coords: list[str], centers: list[list[Center]], starts: list[int]) -> DataFrame:
    """``start, cluster, n`` and coordinate sums of each task's rows, whole arrays at a time. The distances are those of ``squared_distance``, term by term; sums are of whole numbers."""
    k = len(centers[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(starts), k, 1 + len(coords)), dtype=np.int64)
        for batch in batches:
            x = np.stack([np.ones(batch.num_rows, dtype=np.int64), *[col.to_numpy() for col in batch.columns]])
            values = x[1:].astype(float)
            for i, s in enumerate(starts):
                away = []
                for m in centers[s]:
                    total = (values[0] - m[0]) * (values[0] - m[0])
                    for v, at in zip(values[1:], m[1:]):
                        total = total + (v - at) * (v - at)
                    away.append(total)
                own = np.argmin(away, axis=0)  # the first of equals
                for j in range(k):
                    found[i, j] += x[:, own == j].sum(axis=1)
        i, j = np.nonzero(found[:, :, 0])
        columns = [np.array(starts, dtype=np.int32)[i], j.astype(np.int32), *found[i, j].T]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["start", "cluster", "n", *coords])

    return points.select(*[c(n) for n in coords]).mapInArrow(work, "start int, cluster int, n long, " + ", ".join(f"`{n}` long" for n in coords))


def _turns(point: list[Column], centers: list[list[Center]], starts: list[int]) -> Column:
    """(start, cluster) of the row for each start; the centres are one literal, so that an iteration needs no new code."""
    held = F.from_json(F.lit(json.dumps([{"start": s, "m": centers[s]} for s in starts])), "array<struct<start: int, m: array<array<double>>>>")
    values = [p.cast("double") for p in point]

    def distance(m: Column) -> Column:
        parts = [(v - F.get(m, F.lit(i))) * (v - F.get(m, F.lit(i))) for i, v in enumerate(values)]
        total = parts[0]
        for more in parts[1:]:
            total = total + more
        return total

    away = F.transform(held, lambda s: F.struct(s["start"].alias("start"), F.transform(s["m"], distance).alias("d")))
    return F.transform(away, lambda s: F.struct(s["start"].alias("start"), (F.array_position(s["d"], F.array_min(s["d"])) - 1).cast("int").alias("cluster")))


def _first_centers(points: DataFrame, coords: list[str], key: str, k: int, seed: int, starts: int, rows: int) -> list[list[Center]]:
    """The first k different points of each start in the order of their hashes.

    Only rows whose hash lies below a bound are read, about ``SEED_ROWS`` a start; the bound rises until each start has its points.
    """
    share = SEED_ROWS / max(rows, 1)
    while True:
        bound = f"{min(int(share * 16**12), 16**12 - 1):012x}g" if share < 1 else "g"  # hex digits sort before g
        tries = F.array(*[F.struct(F.lit(s).alias("start"), row_hash(seed + s, [key]).alias("h")) for s in range(starts)])
        found = points.select(*coords, F.inline(F.filter(tries, lambda t: t["h"] < F.lit(bound))))
        low = found.groupBy("start", *coords).agg(F.min("h").alias("h")).orderBy("start", "h").collect()
        firsts: list[list[Center]] = [[] for _ in range(starts)]
        for r in low:
            if len(firsts[r["start"]]) < k:
                firsts[r["start"]].append(tuple(float(r[n]) for n in coords))
        if all(len(f) == k for f in firsts):
            return firsts
        if share >= 1:
            raise ValueError(f"{k} clusters need at least {k} different points")
        share *= 16


def fit(points: DataFrame, coords: list[str], key: str, k: int, seed: int = 42, starts: int = 10, max_iterations: int = 300, tolerance: float = 1e-4) -> KMeansFit:
    """Cluster the whole-number columns ``coords``; ``points`` is read once per iteration, so pass a materialised table without nulls.

    A start rests when the squared movement of its centres is at most ``tolerance`` in units of the coordinates; a cluster that loses all its rows keeps its centre.
    """
    rows = points.count()
    centers = _first_centers(points, coords, key, k, seed, starts, rows)
    moving, done = set(range(starts)), 0
    columns = [c(n) for n in coords]
    while moving and done < max_iterations:
        done += 1
        if rows > COMPILED_ROWS:
            parts = _sums_of_batches(points, coords, centers, sorted(moving))
        else:
            parts = points.select(F.inline(_turns(columns, centers, sorted(moving))), F.lit(1).alias("n"), *coords)
        sums = parts.groupBy("start", "cluster").agg(*[F.sum(n).alias(n) for n in ("n", *coords)])
        found = {(r["start"], r["cluster"]): r for r in sums.collect()}  # starts x clusters rows
        for s in sorted(moving):
            new = [tuple(found[s, j][n] / found[s, j]["n"] for n in coords) if (s, j) in found else centers[s][j] for j in range(k)]
            shift = sum(((a - b) / GRID) ** 2 for old, now in zip(centers[s], new) for a, b in zip(old, now))
            centers[s] = new
            if shift <= tolerance:
                moving.discard(s)
    costs = points.agg(*[F.sum((F.array_min(F.array(*[squared_distance(columns, m) for m in centers[s]])) / GRID).cast("decimal(28,0)")).alias(f"s{s}") for s in range(starts)]).first()
    best = min(range(starts), key=lambda s: (costs[s], s))
    return KMeansFit(centers[best], float(costs[best]) / GRID, done)
