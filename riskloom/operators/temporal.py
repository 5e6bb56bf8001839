"""Gaps between transactions, velocity over active days, and calendar modes.

A plain ``lag`` window per customer sorts all rows of one customer in one task.
Here the order is built in steps: distinct times are counted first (copies of
one time collapse before the shuffle), each customer-hour is sorted on its own,
and only one summary row per customer-hour goes on to the customer level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.functions.exprs import MICROS_PER_DAY, c, elapsed_micros
from riskloom.operators.aggregate import with_customer

VELOCITY_WINDOWS = (1, 7, 30)  # fixed values: window lengths in active days
_ID, _HOUR, _TS, _N = "__id", "__hour", "__ts", "__n"


def _days(micros: Column) -> Column:
    return micros / F.lit(MICROS_PER_DAY)


def _distinct_times(txn: DataFrame, cols: TxnColumns) -> DataFrame:
    """One row per customer and distinct time with its count and the gap inside its hour."""
    rows = with_customer(txn, cols).where(c(cols.time).isNotNull()).select(c(cols.id).alias(_ID), c(cols.time).alias(_TS))
    counted = rows.groupBy(_ID, F.date_trunc("hour", _TS).alias(_HOUR), _TS).agg(F.count("*").alias(_N))
    in_hour = Window.partitionBy(_ID, _HOUR).orderBy(_TS)
    return counted.withColumn("__prev", F.lag(_TS).over(in_hour))


def _hours(times: DataFrame) -> DataFrame:
    """One row per customer-hour: count, first and last time, smallest and largest inner gap."""
    gap = elapsed_micros(F.col(_TS), F.col("__prev"))
    smallest = F.when(F.col(_N) > 1, F.lit(0).cast("bigint")).otherwise(gap)
    return times.groupBy(_ID, _HOUR).agg(
        F.sum(_N).alias(_N), F.min(_TS).alias("first"), F.max(_TS).alias("last"),
        F.min(smallest).alias("gap_min"), F.max(F.coalesce(gap, F.when(F.col(_N) > 1, 0))).alias("gap_max"))


def _with_previous_hour(hours: DataFrame) -> DataFrame:
    per_customer = Window.partitionBy(_ID).orderBy(_HOUR)
    return hours.withColumn("before", F.lag("last").over(per_customer))


def daily_counts(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Transactions per customer and active day."""
    rows = with_customer(txn, cols).where(c(cols.time).isNotNull())
    return rows.groupBy(c(cols.id), F.to_date(c(cols.time)).alias("TransactionDate")).agg(F.count("*").alias("transactions"))


def days_since_previous(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Row per transaction: days since the customer's previous one, null for the first.

    Transactions at the same instant follow each other with gap 0.
    """
    times = _distinct_times(txn, cols)
    carried = _with_previous_hour(times.groupBy(_ID, _HOUR).agg(F.max(_TS).alias("last"))).select(_ID, _HOUR, "before")
    full = times.join(carried, [_ID, _HOUR])
    gap = _days(elapsed_micros(F.col(_TS), F.coalesce("__prev", "before")))
    copies = full.select(_ID, _TS, gap.alias("gap"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_N))).alias("copy"))
    return copies.select(F.col(_ID).alias(cols.id), F.col(_TS).alias(cols.time),
                         F.when(F.col("copy") == 1, F.col("gap")).otherwise(F.lit(0.0)).alias("TimeSinceLast"))


def _rolling_mean(days: int, calendar: bool) -> Column:
    """Mean daily count over the last ``days`` active days, or calendar days if asked."""
    if calendar:
        span = Window.partitionBy(_ID).orderBy("__day_number").rangeBetween(-(days - 1), 0)
        return F.sum(_N).over(span) / F.lit(days)
    return F.avg(_N).over(Window.partitionBy(_ID).orderBy("__day").rowsBetween(-(days - 1), 0))


def _customer_days(txn: DataFrame, cols: TxnColumns) -> DataFrame:
    return daily_counts(txn, cols).select(
        c(cols.id).alias(_ID), F.col("TransactionDate").alias("__day"), F.col("transactions").alias(_N))


def _with_rolling(days: DataFrame, windows: tuple[int, ...], calendar: bool) -> DataFrame:
    numbered = days.withColumn("__day_number", F.unix_date("__day"))
    return numbered.withColumns({f"__v{w}": _rolling_mean(w, calendar) for w in windows})


def _with_parts(days: DataFrame, carried: list[str]) -> DataFrame:
    """Three rows per day: its day of month, month and year; other columns go with the year."""
    pairs = F.array(*[F.struct(F.lit(n).alias("part"), e.alias("v")) for n, e in
                      (("Day", F.dayofmonth("__day")), ("Month", F.month("__day")), ("Year", F.year("__day")))])
    long = days.select(_ID, _N, *carried, F.inline(pairs))
    return long.withColumns({n: F.when(F.col("part") == "Year", F.col(n)) for n in carried})


def _mode(part: str) -> Column:
    """Value with the largest count, the smallest on ties: both packed into one number for a hash aggregate."""
    packed = F.max(F.when(F.col("part") == part, F.shiftleft("n", 16) + (F.lit(65_535) - F.col("v"))))
    return (F.lit(65_535) - F.pmod(packed, F.lit(65_536))).cast("int").alias(f"{part}_mode")


def velocity(txn: DataFrame, cols: TxnColumns = DEFAULT, windows: tuple[int, ...] = VELOCITY_WINDOWS, calendar: bool = False) -> DataFrame:
    """Average rolling transaction count per customer; windows count active days by default."""
    days = _with_rolling(_customer_days(txn, cols), windows, calendar)
    return days.groupBy(_ID).agg(*[F.avg(f"__v{w}").alias(f"Velocity_{w}d_mean") for w in windows]).withColumnRenamed(_ID, cols.id)


def calendar_modes(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Most frequent day of month, month and year per customer, smallest on ties."""
    counts = _with_parts(_customer_days(txn, cols), []).groupBy(_ID, "part", "v").agg(F.sum(_N).alias("n"))
    return counts.groupBy(_ID).agg(*[_mode(p) for p in ("Day", "Month", "Year")]).withColumnRenamed(_ID, cols.id)


def gap_statistics(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Mean, smallest and largest gap between a customer's transactions, in days."""
    return temporal_features(txn, cols, windows=()).drop("Day_mode", "Month_mode", "Year_mode")


def temporal_features(
    txn: DataFrame,
    cols: TxnColumns = DEFAULT,
    gaps: bool = True,
    windows: tuple[int, ...] = VELOCITY_WINDOWS,
    calendar_velocity: bool = False,
) -> DataFrame:
    """Calendar modes, gap statistics and velocities, one row per customer.

    One chain without joins: after the customer-hour summary everything runs on
    one hash partitioning by customer, over at most one row per hour.
    """
    hours = _with_previous_hour(_hours(_distinct_times(txn, cols)))
    across = elapsed_micros(F.col("first"), F.col("before"))
    days = hours.groupBy(_ID, F.to_date(_HOUR).alias("__day")).agg(
        F.sum(_N).alias(_N), F.min("first").alias("first"), F.max("last").alias("last"),
        F.min(F.least("gap_min", across)).alias("gap_min"), F.max(F.greatest("gap_max", across)).alias("gap_max"))
    days = _with_rolling(days, windows, calendar_velocity) if windows else days
    sums = [f"__v{w}" for w in windows]
    ends = {"first": F.min, "last": F.max, "gap_min": F.min, "gap_max": F.max} if gaps else {}
    counts = _with_parts(days, [*ends, *sums]).groupBy(_ID, "part", "v").agg(
        F.sum(_N).alias("n"), F.count("*").alias("days"),
        *[f(n).alias(n) for n, f in ends.items()], *[F.sum(n).alias(n) for n in sums])
    in_years = F.col("part") == "Year"
    aggs = [_mode(p) for p in ("Day", "Month", "Year")]
    if gaps:
        # consecutive gaps add up to the whole span
        span = elapsed_micros(F.max("last"), F.min("first"))
        aggs += [_days(F.try_divide(span, F.sum(F.when(in_years, F.col("n"))) - 1)).alias("TimeSinceLast_mean"),
                 _days(F.min("gap_min")).alias("TimeSinceLast_min"),
                 _days(F.max("gap_max")).alias("TimeSinceLast_max")]
    aggs += [(F.sum(f"__v{w}") / F.sum(F.when(in_years, F.col("days")))).alias(f"Velocity_{w}d_mean") for w in windows]
    return counts.groupBy(_ID).agg(*aggs).withColumnRenamed(_ID, cols.id)
