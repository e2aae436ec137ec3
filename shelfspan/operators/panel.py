"""Dense panel construction, reshaping and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.schemas import SALES_IDS, SERIES


def day_columns(df: DataFrame, prefix: str = "d_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def melt(wide: DataFrame, ids: Sequence[str] = SALES_IDS, days: Sequence[str] | None = None) -> DataFrame:
    """Wide daily sales to one row per series and day, with the day number."""
    days = list(days) if days is not None else day_columns(wide)
    long = wide.select(*ids, *days).unpivot(list(ids), days, "d", "demand")
    return long.withColumn("day_num", F.regexp_extract("d", "([0-9]+)", 1).cast("int"))


def daily_sums(sales: DataFrame, keys: Sequence[str] = SERIES, date: str = "date", amount: str = "demand", whole: bool = False) -> DataFrame:
    """Sales summed map-side to one row per series and day; ``whole`` cuts the sums, not the amounts, to whole units."""
    return sales.groupBy(*keys, date).agg((F.sum(amount).cast("long") if whole else F.sum(amount)).alias(amount))


def expand_gaps(sums: DataFrame, low: Column, high: Column, keys: Sequence[str] = SERIES, date: str = "date", amount: str = "demand") -> DataFrame:
    """One row per series and day between two dates from one row per day with sales.

    Every row is repeated for the days up to the next one of its series, with 0
    on all but its own; the first one also covers the days before it. No table
    of days is joined, and one exchange on the series does it. Days outside the
    two dates and null days add no amount but keep their series.
    """
    inside = F.col(date).between(low, high)
    held = sums.select(*keys, F.when(inside, F.col(date)).alias("_day"), F.when(inside, F.col(amount)).alias(amount)).withColumns(
        {"_before": F.lag("_day").over(series_window(keys, "_day")), "_next": F.lead("_day").over(series_window(keys, "_day"))}
    )
    used = held.where(F.col("_day").isNotNull() | (F.col("_next").isNull() & F.col("_before").isNull()))
    one = F.expr("interval 1 day")
    start = F.when(F.col("_before").isNull(), low).otherwise(F.col("_day"))
    days = F.sequence(start, F.coalesce(F.date_sub("_next", 1), high), one)
    own = F.coalesce(F.col(date) == F.col("_day"), F.lit(False))
    zero = F.lit(0).cast(sums.schema[amount].dataType)
    return used.select("*", F.explode(days).alias(date)).select(*keys, date, F.when(own, F.coalesce(amount, zero)).otherwise(zero).alias(amount))


def densify(
    sales: DataFrame, low: Column, high: Column, keys: Sequence[str] = SERIES, date: str = "date", amount: str = "demand", whole: bool = False
) -> DataFrame:
    """One row per series and day between two dates, zero where nothing sold.

    The sales are read once. A series holds at most one row a day when it is
    exchanged, so it never outgrows the calendar. Sums keep the type of the
    amounts.
    """
    marked = sales.withColumn(date, F.when(F.col(date).between(low, high), F.col(date)))
    return expand_gaps(daily_sums(marked, keys, date, amount, whole), low, high, keys, date, amount)


def series_window(keys: Sequence[str] = SERIES, order: str = "date") -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def trailing(rows: int, keys: Sequence[str] = SERIES, order: str = "date", shift: int = 0):
    """The last ``rows`` rows; ``shift=1`` leaves the current row out."""
    return series_window(keys, order).rowsBetween(-(rows - 1) - shift, -shift)


def filled(value: str, keys: Sequence[str] = SERIES, order: str = "date") -> Column:
    """Last known value, else the first known one of the series.

    What a backward fill adds after a forward fill is always the first known
    value, so a whole-partition frame gives it in linear time.
    """
    w = series_window(keys, order)
    so_far = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    leading = F.first(value, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return F.coalesce(so_far, leading)


def fill_indicators(df: DataFrame, columns: Sequence[str], date: str = "date") -> DataFrame:
    """Forward fill of wide indicator columns, done per indicator on long rows."""
    long = df.unpivot(date, list(columns), "indicator", "value")
    w = Window.partitionBy("indicator").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    carried = long.withColumn("value", F.last("value", ignorenulls=True).over(w))
    picks = [F.max(F.when(F.col("indicator") == c, F.col("value"))).alias(c) for c in columns]
    return carried.groupBy(date).agg(*picks)


def date_gaps(df: DataFrame, date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Steps between consecutive distinct days that are not exactly one day."""
    days = df.select(*by, date).distinct()
    w = Window.partitionBy(*by).orderBy(date) if by else Window.orderBy(date)
    step = F.datediff(F.col(date), F.lag(date).over(w))
    return days.withColumn("step_days", step).where(F.col("step_days") != 1)


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; empty inputs add nothing."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged
