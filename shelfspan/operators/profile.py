"""Exploration aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import bin_number, flag
from shelfspan.operators.ordering import percentile_columns


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("demand").alias("demand"))


def mean_daily_total(df: DataFrame, part: F.Column, name: str) -> DataFrame:
    """Mean of the daily totals by a part of the date."""
    return daily_totals(df).groupBy(part.alias(name)).agg(F.avg("demand").alias("avg_daily"))


def category_profile(df: DataFrame, by: str = "cat_id") -> DataFrame:
    """Total, mean, deviation and count by category, largest total first."""
    stats = df.groupBy(by).agg(
        F.round(F.sum("demand"), 2).alias("total_sales"),
        F.round(F.avg("demand"), 2).alias("avg_sales"),
        F.round(F.stddev_samp("demand"), 2).alias("std_sales"),
        F.count("demand").alias("records"),
    )
    return stats.orderBy(F.desc("total_sales"), by)


def zero_share(df: DataFrame, by: str = "cat_id") -> DataFrame:
    """Percentage of rows without demand."""
    return df.groupBy(by).agg((F.avg(flag(F.col("demand") == 0).cast("double")) * 100).alias("zero_pct"))


def price_stats(df: DataFrame, by: str = "cat_id") -> DataFrame:
    """Price statistics over the rows that have a price."""
    return df.dropna(subset=["sell_price"]).groupBy(by).agg(
        F.avg("sell_price").alias("mean"), F.stddev_samp("sell_price").alias("std"),
        F.min("sell_price").alias("min"), F.max("sell_price").alias("max"), F.count("sell_price").alias("count"),
    )


def price_demand_correlation(df: DataFrame, by: str = "cat_id") -> DataFrame:
    """Correlation of price and demand; null for a single row."""
    known = df.dropna(subset=["sell_price"])
    value = F.corr("sell_price", F.col("demand").cast("double"))
    return known.groupBy(by).agg(F.when(F.count(F.lit(1)) > 1, value).alias("price_demand_corr"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles as one row."""
    basic = df.agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )
    quartiles = percentile_columns(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.withColumns({name: quartiles.select(name).scalar() for name in ("q25", "q50", "q75")})


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def summary(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Table-level scalars of the exploration report as one row."""
    sales = df.agg(
        F.count_distinct("item_id").alias("total_items"),
        F.count_distinct("store_id").alias("total_stores"),
        F.count_distinct("d").alias("total_days"),
        F.count(F.lit(1)).alias("total_records"),
        F.avg("demand").alias("avg_daily_demand"),
        (F.avg(flag(F.col("demand") == 0).cast("double")) * 100).alias("zero_sales_pct"),
        F.max("demand").alias("max_daily_demand"),
        F.stddev_samp("demand").alias("std_demand"),
    )
    cost = prices.agg(
        F.count(F.lit(1)).alias("price_records"), F.min("sell_price").alias("min_price"), F.max("sell_price").alias("max_price")
    )
    return sales.withColumns(
        {name: cost.select(name).scalar() for name in ("price_records", "min_price", "max_price")}
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass, as one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def completeness(df: DataFrame, below: float | None = None) -> DataFrame:
    """Percentage of known values per column; only the low ones if asked."""
    n = F.count(F.lit(1))
    shares = df.agg(*[((1 - F.try_divide(F.count_if(F.col(c).isNull()), n)) * 100).alias(c) for c in df.columns])
    long = shares.unpivot([], df.columns, "column", "completeness")
    return long if below is None else long.where(F.col("completeness") < below)


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Counts in equal-width bins over the range of each group.

    Rows are counted by value before they meet their group's range, and groups
    are few (categories), so nothing but counts is shuffled.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    if by:
        ranges = counts.groupBy(*by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"), F.sum("_n").alias("_all"))
        counts = counts.join(ranges, list(by))
    else:
        low, high, total = (counts.agg(a).scalar() for a in (F.min(column), F.max(column), F.sum("_n")))
        counts = counts.withColumns({"_low": low, "_high": high, "_all": total})
    width = (F.col("_high") - F.col("_low")) / bins
    placed = counts.withColumns(
        {"bin": bin_number(F.col(column), F.col("_low"), width, bins), "_width": width}
    )
    out = placed.groupBy(*by, "bin", "_low", "_width", "_all").agg(F.sum("_n").alias("n"))
    left = F.col("_low") + F.col("bin") * F.col("_width")
    picked = [*by, "bin", left.alias("left_edge"), "n"]
    if density:
        picked.append(F.try_divide(F.col("n"), F.col("_all") * F.col("_width")).alias("density"))
    return out.select(*picked)


def split_ranges(df: DataFrame, split: str = "split") -> DataFrame:
    """First and last date and row count of each split."""
    return df.groupBy(split).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
