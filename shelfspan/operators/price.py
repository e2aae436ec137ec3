"""Price level, change, momentum and relative-price features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.functions.scalar import binned, flag, ratio
from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import percentile_columns
from shelfspan.operators.panel import filled, series_window, trailing
from shelfspan.schemas import MOMENTUM_WINDOWS, SERIES

PRICE_LABELS = ("very_low", "low", "medium", "high", "very_high")


def fill_prices(df: DataFrame, keys=SERIES) -> DataFrame:
    """Forward then backward fill of the price within each series."""
    return df.withColumn("sell_price", filled("sell_price", keys))


def change(value: str, keys=SERIES, order: str = "date", periods: int = 1) -> Column:
    """Difference to an earlier row."""
    return F.col(value) - F.lag(value, periods).over(series_window(keys, order))


def relative_change(value: Column, previous: Column) -> Column:
    return ratio(value, previous) - 1


def add_relative_change(df: DataFrame, name: str, value: str, keys=SERIES, order: str = "date", periods: int = 1) -> DataFrame:
    """Fractional change; a missing value counts as the last known one."""
    w = series_window(keys, order)
    padded = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_padded", padded)
    shifted = relative_change(F.col("_padded"), F.lag("_padded", periods).over(w))
    return df.withColumn(name, shifted).drop("_padded")


def full_frame_mean(value: str, rows: int, keys=SERIES, order: str = "date") -> Column:
    """Mean over exactly ``rows`` known values, else null."""
    frame = trailing(rows, keys, order)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def momentum_columns(windows: Sequence[int] = MOMENTUM_WINDOWS, keys=SERIES) -> dict[str, Column]:
    """Full-frame means of the price; they carry the historic name ``price_momentum``."""
    return {f"price_momentum_{n}": full_frame_mean("sell_price", n, keys) for n in windows}


def add_price_windows(df: DataFrame, momentum: Sequence[int] = MOMENTUM_WINDOWS, keys=SERIES) -> DataFrame:
    """Change, fractional change and full-frame means of the price."""
    df = df.withColumns({"price_change": change("sell_price", keys), **momentum_columns(momentum, keys)})
    return add_relative_change(df, "price_change_pct", "sell_price", keys)


def discount_columns() -> dict[str, Column]:
    drop = F.col("price_change")
    return {
        "is_discount": flag(drop < -0.01),
        "discount_magnitude": F.when(drop < 0, F.abs(drop)).otherwise(0.0),
    }


def add_discounts(df: DataFrame) -> DataFrame:
    """Discount flag (a drop of more than one cent) and the size of any drop."""
    return df.withColumns(discount_columns())


def group_mean(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Mean of a value per group, pre-aggregated before its shuffle."""
    return df.groupBy(*by).agg(F.avg(value).alias(name))


def add_group_ratio(df: DataFrame, value: str, by: Sequence[str], name: str, spread_by: Sequence[str] = ("date",)) -> DataFrame:
    """Value relative to its group mean, by aggregate and sized join.

    A window over the group would put a whole category in one task.
    """
    means = group_mean(df, value, by, "_mean")
    spread = [c for c in (*spread_by, *SERIES) if c not in by]
    joined = attach(df, means, by, spread_by=spread)
    return joined.withColumn(name, ratio(F.col(value), F.col("_mean"))).drop("_mean")


def add_rolling_price(df: DataFrame, rows: int = 28, keys=SERIES) -> DataFrame:
    """Rolling mean price and the price relative to it."""
    name = f"price_rolling_mean_{rows}"
    df = df.withColumn(name, F.avg("sell_price").over(trailing(rows, keys)))
    return df.withColumn("price_relative_to_avg", ratio(F.col("sell_price"), F.col(name)))


def quintile_edges(df: DataFrame) -> DataFrame:
    """Inner quintile edges of the price, as one row."""
    return percentile_columns(df, "sell_price", {"q20": 0.2, "q40": 0.4, "q60": 0.6, "q80": 0.8})


def add_price_bin(df: DataFrame) -> DataFrame:
    """Right-closed price quintile labels."""
    edges = quintile_edges(df)
    bounds = [edges.select(name).scalar() for name in ("q20", "q40", "q60", "q80")]
    return df.withColumn("price_bin", binned(F.col("sell_price"), bounds, PRICE_LABELS))
