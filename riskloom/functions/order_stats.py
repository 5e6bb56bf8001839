"""Exact quantiles, ranks and running totals without a single-task sort.

``percentile`` keeps every distinct value of a column in one buffer and an
unpartitioned window sorts a table in one task. The functions here give the
same exact answers with bounded state: approximate quantiles only say *where*
to look, counts decide what the answer is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exprs import c, is_fractional
from riskloom.functions.joins import freeze
from riskloom.session import materialize

ONE_PASS_VALUES = 4_000_000  # rows x columns up to which one built-in percentile aggregate is used
COLLECT_VALUES = 500_000  # distinct values the driver may look at per round
SAMPLED_KEYS = 2_000


@dataclass(frozen=True)
class _Gap:
    """Open interval of one column known to hold rank ``rank``."""

    col: str
    rank: int
    lo: Any
    hi: Any
    below: int  # values <= lo
    size: int  # values strictly inside

    def holds(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.lo is not None:
            test &= value > F.lit(self.lo)
        if self.hi is not None:
            test &= value < F.lit(self.hi)
        return test


def _clean(df: DataFrame, name: str) -> Column:
    """Column as compared: NaN is missing, floats widen to double."""
    if is_fractional(df, name):
        return F.nullif(c(name).cast("double"), F.lit(float("nan")))
    return c(name)


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], collect_limit: int = COLLECT_VALUES) -> dict[str, dict[int, Any]]:
    """The values at the given 1-based ranks of each column's non-null values.

    Every round aggregates counts around a few split points and keeps only the
    interval that holds the wanted rank (about 0.1 % of the rows), until the
    interval is small enough to read. Repeated values fall on a split point and
    need no further round, so a value held by a third of all rows costs nothing.
    """
    work = df.select(*[_clean(df, n).alias(n) for n in ranks])
    sizes = work.agg(*[F.count(c(n)).alias(n) for n in ranks]).first().asDict()
    found: dict[str, dict[int, Any]] = {n: {} for n in ranks}
    open_gaps = [_Gap(n, r, None, None, 0, sizes[n]) for n, rs in ranks.items() for r in sorted(set(rs))]
    for gap in open_gaps:
        if not 1 <= gap.rank <= gap.size:
            raise ValueError(f"rank {gap.rank} outside 1..{gap.size} for {gap.col}")
    while open_gaps:
        small, large, budget = [], [], collect_limit
        for gap in sorted(open_gaps, key=lambda g: g.size):
            key = (gap.col, gap.lo, gap.hi)
            if any(key == (s.col, s.lo, s.hi) for s in small) or gap.size <= budget:
                budget -= 0 if any(key == (s.col, s.lo, s.hi) for s in small) else gap.size
                small.append(gap)
            else:
                large.append(gap)
        if small:
            _read_small(work, small, found)
        open_gaps = _narrow(work, large, found) if large else []
    return found


def _read_small(work: DataFrame, gaps: list[_Gap], found: dict) -> None:
    """Resolve ranks in intervals whose total size is below the driver limit."""
    by_type: dict[str, dict[tuple, list[_Gap]]] = {}
    for gap in gaps:
        group = by_type.setdefault(work.schema[gap.col].dataType.simpleString(), {})
        group.setdefault((gap.col, gap.lo, gap.hi), []).append(gap)
    for intervals in by_type.values():
        tagged = [F.when(gs[0].holds(c(key[0])), F.struct(F.lit(i).alias("i"), c(key[0]).alias("v")))
                  for i, (key, gs) in enumerate(intervals.items())]
        rows = (work.select(F.explode(F.array_compact(F.array(*tagged))).alias("t"))
                .groupBy("t.i", "t.v").count().orderBy("i", "v").collect())
        for i, gs in enumerate(intervals.values()):
            for gap in gs:
                seen = gap.below
                for row in rows:
                    if row["i"] == i:
                        seen += row["count"]
                        if seen >= gap.rank:
                            found[gap.col][gap.rank] = row["v"]
                            break


def _narrow(work: DataFrame, gaps: list[_Gap], found: dict) -> list[_Gap]:
    """One counting round over all large intervals; ranks of one interval share its split points."""
    intervals: dict[tuple, list[_Gap]] = {}
    for gap in gaps:
        intervals.setdefault((gap.col, gap.lo, gap.hi), []).append(gap)
    groups = list(intervals.values())
    points = _points_near(work, groups)
    exprs = []
    for i, group in enumerate(groups):
        x, inside = c(group[0].col), group[0].holds(c(group[0].col))
        for j, p in enumerate(points[i]):
            exprs += [F.count_if(inside & (x < F.lit(p))).alias(f"lt_{i}_{j}"), F.count_if(inside & (x <= F.lit(p))).alias(f"le_{i}_{j}")]
    counts = work.agg(*exprs).first()
    still_open = []
    for i, group in enumerate(groups):
        for gap in group:
            want, lo, lo_count = gap.rank - gap.below, gap.lo, 0
            for j, p in enumerate(points[i]):
                lt, le = counts[f"lt_{i}_{j}"], counts[f"le_{i}_{j}"]
                if want <= lt:
                    still_open.append(_Gap(gap.col, gap.rank, lo, p, gap.below + lo_count, lt - lo_count))
                    break
                if want <= le:
                    found[gap.col][gap.rank] = p
                    break
                lo, lo_count = p, le
            else:
                still_open.append(_Gap(gap.col, gap.rank, lo, gap.hi, gap.below + lo_count, gap.size - lo_count))
    return still_open


def _points_near(work: DataFrame, groups: list[list[_Gap]]) -> list[list]:
    """Data values close to each wanted rank; any choice is correct, a close one is fast."""
    points: list[list] = [[] for _ in groups]
    numeric = {}
    for i, group in enumerate(groups):
        first = group[0]
        shares = [(g.rank - g.below) / g.size for g in group]
        if isinstance(work.schema[first.col].dataType, T.NumericType):
            near = sorted({round(min(1.0, max(0.0, p + d)), 6) for p in shares for d in (-5e-4, 0.0, 5e-4)})
            numeric[i] = F.approx_percentile(F.when(first.holds(c(first.col)), c(first.col)), near, 10_000).alias(f"p{i}")
        else:
            keys = _sampled_keys(work.where(first.holds(c(first.col))), first.col, first.size)
            spread = 3 * math.sqrt(len(keys))
            picks = {min(len(keys) - 1, max(0, int(p * len(keys) + d))) for p in shares for d in (-spread, 0, spread)}
            points[i] = sorted({keys[k] for k in picks})
    if numeric:
        row = work.agg(*numeric.values()).first()
        for i in numeric:
            points[i] = sorted(set(row[f"p{i}"]))
    return points


def _sampled_keys(df: DataFrame, name: str, n_rows: int, want: int = SAMPLED_KEYS) -> list:
    """A bounded, sorted sample used to place split points (never to drop rows)."""
    fraction = min(1.0, 2.0 * want / max(n_rows, 1))
    rows = df.select(c(name).alias("k")).where(F.col("k").isNotNull())
    picked = rows.sample(fraction=fraction, seed=7).limit(4 * want).collect() or rows.limit(want).collect()
    return sorted(r["k"] for r in picked)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    one_pass_values: int = ONE_PASS_VALUES, collect_limit: int = COLLECT_VALUES) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles (the numpy / pandas default) per numeric column."""
    if not cols:
        return {}
    work = df.select(*[_clean(df, n).cast("double").alias(n) for n in cols])
    counts = work.agg(*[F.count(c(n)).alias(n) for n in cols]).first().asDict()
    if sum(counts.values()) <= one_pass_values:
        row = work.agg(*[F.percentile(c(n), list(probs)).alias(n) for n in cols]).first().asDict()
        return {n: list(row[n]) if row[n] is not None else [None] * len(probs) for n in cols}
    wanted: dict[str, list[int]] = {}
    for n in cols:
        if counts[n]:
            at = [(counts[n] - 1) * p for p in probs]
            wanted[n] = sorted({int(k) + 1 for pos in at for k in (math.floor(pos), math.ceil(pos))})
    values = order_statistics(work, wanted, collect_limit)
    result: dict[str, list[float | None]] = {}
    for n in cols:
        if not counts[n]:
            result[n] = [None] * len(probs)
            continue
        result[n] = []
        for p in probs:
            pos = (counts[n] - 1) * p
            low, high = values[n][math.floor(pos) + 1], values[n][math.ceil(pos) + 1]
            result[n].append(low + (high - low) * (pos - math.floor(pos)))
    return result


def split_points(df: DataFrame, name: str, n_rows: int, rows_per_split: int = 200_000, max_splits: int = 1_024) -> list:
    """Frozen, strictly increasing values that cut the column into similar parts."""
    parts = min(max_splits, n_rows // rows_per_split + 1)
    if parts <= 1:
        return []
    if isinstance(df.schema[name].dataType, T.NumericType):
        probs = [i / parts for i in range(1, parts)]
        return sorted(set(df.agg(F.approx_percentile(c(name), probs, 10_000)).first()[0]))
    keys = _sampled_keys(df, name, n_rows, want=8 * parts)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)})


def split_index(value: Column, points: list) -> Column:
    """Number of split points at or below the value: a coarse search, then a fine one."""
    if not points:
        return F.lit(0)
    step = max(1, math.isqrt(len(points)))
    blocks = [points[i:i + step] for i in range(0, len(points), step)]
    coarse = F.size(F.filter(F.array(*[F.lit(b[0]) for b in blocks]), lambda p: p <= value))
    fine = F.element_at(F.array(*[F.array(*[F.lit(p) for p in b]) for b in blocks]), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(F.filter(fine, lambda p: p <= value)))


def running_totals(df: DataFrame, order_col: str, sums: dict[str, str], ascending: bool = True,
                   rows_per_split: int = 200_000) -> DataFrame:
    """Add ``new_name = running sum of column`` over the whole table in ``order_col`` order.

    ``order_col`` must be unique (group first). Rows are cut at frozen split
    points; each part is summed in its own task and starts from the total of the
    parts before it.
    """
    n_rows = df.count()
    direction = c(order_col) if ascending else c(order_col).desc()

    def totals(window) -> list[Column]:
        return [F.sum(c(src)).over(window).alias(new) for new, src in sums.items()]

    if n_rows <= rows_per_split:  # measured: one task can sort it
        whole = Window.partitionBy(F.lit(0)).orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *totals(whole))
    part, df = "__part", materialize(df, "running-totals")
    tagged = df.withColumn(part, split_index(c(order_col), split_points(df, order_col, n_rows, rows_per_split)))
    sizes = tagged.groupBy(part).agg(*[F.sum(c(src)).alias(new) for new, src in sums.items()])
    before = Window.orderBy(F.col(part) if ascending else F.col(part).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # one row per part, at most max_splits + 1
    offsets = freeze(sizes.select(F.col(part).alias("__p"), *[F.coalesce(F.sum(new).over(before), F.lit(0)).alias(f"__o_{new}") for new in sums]), "offsets")
    inside = Window.partitionBy(part).orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = offsets.attach(tagged.select("*", *totals(inside)), F.col(part), "__p")
    return running.select(*[c(n) for n in df.columns], *[(c(new) + F.col(f"__o_{new}")).alias(new) for new in sums])


def grouped_running_totals(df: DataFrame, groups: list[str], order_col: str, sums: dict[str, str], ascending: bool = True,
                           rows_per_split: int = 200_000) -> DataFrame:
    """``running_totals`` within each group, all groups in one pass; (groups, ``order_col``) must be unique.

    The same split points of ``order_col`` cut every group, so no task sees more than one part of one group.
    """
    n_rows, df = df.count(), materialize(df, "grouped-totals")
    points = split_points(df, order_col, n_rows, rows_per_split)
    tagged = df.withColumn("__part", split_index(c(order_col), points))
    by = [c(g) for g in groups]
    direction = c(order_col) if ascending else c(order_col).desc()
    inside = Window.partitionBy(*by, "__part").orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = tagged.select("*", *[F.sum(c(src)).over(inside).alias(new) for new, src in sums.items()])
    if not points:
        return running.drop("__part")
    sizes = tagged.groupBy(*by, "__part").agg(*[F.sum(c(src)).alias(f"__{new}") for new, src in sums.items()])
    before = Window.partitionBy(*by).orderBy(F.col("__part") if ascending else F.col("__part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "__part", *[F.coalesce(F.sum(f"__{new}").over(before), F.lit(0)).alias(f"__{new}") for new in sums])
    joined = running.join(offsets, [*groups, "__part"])
    return joined.select(*[c(n) for n in df.columns], *[(c(new) + F.col(f"__{new}")).alias(new) for new in sums])


def dense_codes(df: DataFrame, name: str, rows_per_split: int = 200_000) -> DataFrame:
    """``value, code``: 0-based position of each distinct non-null value in sorted order."""
    distinct = df.select(c(name).alias("value")).where(F.col("value").isNotNull()).distinct().withColumn("one", F.lit(1))
    ranked = running_totals(distinct, "value", {"rank": "one"}, rows_per_split=rows_per_split)
    return ranked.select("value", (F.col("rank") - 1).cast("int").alias("code"))


def with_codes(df: DataFrame, name: str, out: str, codes: DataFrame) -> DataFrame:
    """Attach codes by value; missing and unseen values get -1."""
    lookup = freeze(codes.select(F.col("value").alias("__v"), F.col("code").alias(out)), "codes")
    return lookup.attach(df, c(name), "__v").withColumn(out, F.coalesce(c(out), F.lit(-1)))
