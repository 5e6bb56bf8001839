"""Customer-level aggregates over transactions.

Everything in :func:`customer_aggregates` is a mergeable aggregate evaluated in
one ``groupBy``: executors combine their own rows first, so a customer that
holds a third of the table costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.functions.exprs import c, day_floor, elapsed_micros, nan_to_null, sample_skewness, string_columns
from riskloom.functions.joins import freeze
from riskloom.functions.order_stats import dense_codes
from riskloom.operators.calendar import calendar_means

RECENT_DAYS = 30
FEW_VALUES = 32  # values of a category that are counted in columns of their own
_CODES = 1 << 31  # codes of a category, at most


def with_customer(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Rows without a customer belong to no group."""
    return txn.where(c(cols.id).isNotNull())


def recent_cutoff(txn: DataFrame, cols: TxnColumns = DEFAULT, days: int = RECENT_DAYS) -> Column:
    """Scalar subquery: latest time in the whole table minus ``days``."""
    latest = txn.agg((F.max(c(cols.time)) - F.expr(f"INTERVAL '{int(days)}' DAY")).alias("cutoff"))
    return latest.scalar()


def measure_stats(name: str) -> list[Column]:
    """sum, mean, max, sample std and bias-corrected skew of one measure.

    Mean and std reuse the sum, count and population deviation that the others
    need anyway: partial rows travel through the exchange, so each buffer counts.
    """
    x, n = c(name), F.count(c(name))
    return [
        F.coalesce(F.sum(x), F.lit(0)).alias(f"{name}_sum"),
        F.try_divide(F.sum(x), n).alias(f"{name}_mean"),
        F.max(x).alias(f"{name}_max"),
        F.when(n > 1, F.stddev_pop(x) * F.sqrt(F.try_divide(n, n - 1))).alias(f"{name}_std"),
        sample_skewness(x).alias(f"{name}_skew"),
    ]


def recent_stats(cols: TxnColumns, recent: Column) -> list[Column]:
    """Recent sums and means; a customer without recent rows keeps nulls, not zeros."""
    rows = F.count_if(recent)
    out = []
    for name in (cols.amount, cols.value):
        x = F.when(recent, c(name))
        out += [F.when(rows > 0, F.coalesce(F.sum(x), F.lit(0))).alias(f"Recent30_{name}_sum"),
                F.try_divide(F.sum(x), F.count(x)).alias(f"Recent30_{name}_mean")]
    out.append(F.nullif(rows, F.lit(0)).alias(f"Recent30_{cols.time}_count"))
    return out


def period_days(time: Column) -> Column:
    """Active period in whole elapsed days, plus one."""
    return day_floor(elapsed_micros(F.max(time), F.min(time))) + 1


def customer_aggregates(
    txn: DataFrame,
    cols: TxnColumns = DEFAULT,
    recent: bool = True,
    calendar: bool = True,
    cyclical: bool = True,
    label: bool = True,
    categories: dict[str, list] | None = None,
) -> DataFrame:
    """One row per customer with every mergeable feature, from one scan and one exchange.

    ``categories`` (column: sorted values) adds the most frequent value of each.
    """
    txn = nan_to_null(txn, [n for n in (cols.amount, cols.value) if n in txn.columns])
    time = c(cols.time)
    aggs = [*measure_stats(cols.amount), *measure_stats(cols.value),
            F.count(time).alias(f"{cols.time}_count"), period_days(time).alias(f"{cols.time}_period")]
    rows = txn
    if recent:
        rows = rows.withColumn("__recent", time >= recent_cutoff(txn, cols))
        aggs += recent_stats(cols, F.col("__recent"))
    if calendar:
        aggs += calendar_means(time, cyclical)
    if label and cols.label in txn.columns:
        aggs.append(F.max(c(cols.label)).alias("HasFraud"))
    aggs += [modal_value(n, values, txn.schema[n].dataType) for n, values in (categories or {}).items()]
    return with_customer(rows, cols).groupBy(c(cols.id)).agg(*aggs)


def recent_activity(txn: DataFrame, cols: TxnColumns = DEFAULT, days: int = RECENT_DAYS) -> DataFrame:
    """Aggregates of the last ``days`` only; the filter reaches the scan."""
    rows = with_customer(nan_to_null(txn, [cols.amount, cols.value]), cols)
    rows = rows.where(c(cols.time) >= recent_cutoff(txn, cols, days))
    return rows.groupBy(c(cols.id)).agg(*recent_stats(cols, F.lit(True)))


def customer_target(txn: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Customer label: any transaction with the label set."""
    return with_customer(txn, cols).groupBy(c(cols.id)).agg(F.max(c(cols.label)).alias("HasFraud"))


def fraud_rate(target: DataFrame) -> DataFrame:
    return target.agg(F.count("*").alias("customers"), F.avg("HasFraud").alias("fraud_rate"))


def category_columns(txn: DataFrame, cols: TxnColumns = DEFAULT) -> list[str]:
    """Default categoricals: every text column but key and time."""
    return [n for n in string_columns(txn) if n not in (cols.id, cols.time)]


def category_values(txn: DataFrame, categories: list[str]) -> dict[str, list]:
    """Sorted values of the columns that have at most ``FEW_VALUES`` of them; a sketch keeps the others out."""
    if not categories:
        return {}
    near = txn.agg(*[F.approx_count_distinct(c(n)).alias(n) for n in categories]).first()
    few = [n for n in categories if near[n] <= 2 * FEW_VALUES]
    if not few:
        return {}
    row = txn.agg(*[F.sort_array(F.collect_set(c(n))).alias(n) for n in few]).first()  # bounded by the sketch
    return {n: list(row[n]) for n in few if len(row[n]) <= FEW_VALUES}


def modal_value(name: str, values: list, kind) -> Column:
    """Aggregate: the most frequent of ``values``, the first on ties, null if there is none.

    Count and position are packed in one number, so the largest number is the answer.
    """
    packed = [F.count_if(c(name) == F.lit(v).cast(kind)) * FEW_VALUES + (FEW_VALUES - 1 - i) for i, v in enumerate(values)]
    if not packed:
        return F.max(F.lit(None).cast(kind)).alias(name)
    best = packed[0] if len(packed) == 1 else F.greatest(*packed)
    position = F.lit(FEW_VALUES - 1) - F.pmod(best, F.lit(FEW_VALUES))
    return F.when(best >= FEW_VALUES, F.get(F.array(*[F.lit(v).cast(kind) for v in values]), position.cast("int"))).alias(name)


def _modes_by_code(txn: DataFrame, categories: list[str], cols: TxnColumns) -> DataFrame:
    """Modes of columns with many values: rows are counted per customer and value, then counts and codes packed."""
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), c(n).cast("string").alias("v")) for i, n in enumerate(categories)])
    counts = with_customer(txn, cols).select(c(cols.id).alias("__id"), F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("__id", "f", "v").agg(F.count("*").alias("n"))
    books = [dense_codes(txn, n).select(F.lit(i).alias("f"), F.col("value").cast("string").alias("v"), "code") for i, n in enumerate(categories)]
    book = books[0]
    for more in books[1:]:
        book = book.unionByName(more)
    named = freeze(book, "category-codes")
    key = F.concat_ws(":", "f", "v")
    coded = named.select(key.alias("__key"), F.col("code")).attach(counts, key, "__key")
    packed = F.col("n") * _CODES + (_CODES - 1 - F.col("code"))
    out = coded.groupBy("__id").agg(*[F.max(F.when(F.col("f") == i, packed)).alias(f"__m{i}") for i in range(len(categories))])
    for i, n in enumerate(categories):
        mine = named.where(F.col("f") == i).select((F.lit(_CODES - 1) - F.col("code")).alias("__code"), F.col("v").cast(txn.schema[n].dataType).alias(n))
        out = mine.attach(out, F.pmod(F.col(f"__m{i}"), F.lit(_CODES)), "__code")
    return out.select(F.col("__id").alias(cols.id), *[c(n) for n in categories])


def modal_categories(txn: DataFrame, categories: list[str], cols: TxnColumns = DEFAULT) -> DataFrame:
    """Most frequent value per customer and column, smallest on ties, null if all are null.

    Columns with few values need one aggregate and one exchange. The others are counted per customer and value, and the counts meet sorted codes of the values.
    """
    values = category_values(txn, categories)
    few, many = [n for n in categories if n in values], [n for n in categories if n not in values]
    out = None
    if few or not many:
        out = with_customer(txn, cols).groupBy(c(cols.id)).agg(*[modal_value(n, values[n], txn.schema[n].dataType) for n in few] or [F.count("*").alias("__n")])
    if many:
        # customers without any value of these columns are missing there
        base = out if out is not None else with_customer(txn, cols).groupBy(c(cols.id)).agg(F.count("*").alias("__n"))
        out = base.join(_modes_by_code(txn, many, cols), cols.id, "left")
    return out.select(c(cols.id), *[c(n) for n in categories])
