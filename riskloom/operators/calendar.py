"""Calendar parts of a timestamp and their per-customer averages."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.functions.exprs import c

BUSINESS_HOURS = (9, 17)  # fixed values, both inclusive
WEEKEND = (5, 6)  # fixed values, Monday = 0


def calendar_parts(time: Column, cyclical: bool = True) -> dict[str, Column]:
    """Hour, weekday, day, month, year, flags and the sine / cosine pairs."""
    hour, weekday, month = F.hour(time), F.weekday(time), F.month(time)
    parts = {
        "Hour": hour,
        "Weekday": weekday,
        "Day": F.dayofmonth(time),
        "Month": month,
        "Year": F.year(time),
        "IsWeekend": F.when(time.isNotNull(), weekday.isin(*WEEKEND).cast("int")).otherwise(0),
        "IsBusinessHours": F.when(time.isNotNull(), hour.between(*BUSINESS_HOURS).cast("int")).otherwise(0),
    }
    if cyclical:
        for name, part, cycle in (("Hour", hour, 24), ("Month", month, 12)):
            angle = part * (2 * math.pi / cycle)
            parts[f"{name}_sin"] = F.sin(angle)
            parts[f"{name}_cos"] = F.cos(angle)
    return parts


def calendar_features(txn: DataFrame, cols: TxnColumns = DEFAULT, cyclical: bool = True) -> DataFrame:
    """Transaction rows with their calendar parts: a projection, no shuffle."""
    return txn.withColumns(calendar_parts(c(cols.time), cyclical))


def calendar_means(time: Column, cyclical: bool = True) -> list[Column]:
    """Mean of every part, and the spread of hour and weekday.

    All means share one count, and the spreads come from exact integer sums of
    squares, so a partial row carries one number per statistic.
    """
    parts = calendar_parts(time, cyclical)
    n = F.count(time)
    aggs = []
    for name, part in parts.items():
        if name == "IsBusinessHours" and not cyclical:
            continue
        rows = F.count(F.lit(1)) if name.startswith("Is") else n  # flags are 0 without a time
        aggs.append(F.try_divide(F.sum(part), rows).alias(f"{name}_mean"))
        if name in ("Hour", "Weekday"):
            total, squares = F.sum(part), F.sum(part * part)
            spread = F.greatest(squares - total * F.try_divide(total, n), F.lit(0.0))  # in doubles: no overflow at any count
            aggs.append(F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1))).alias(f"{name}_std"))
    return aggs
