"""Item age, store performance, competition and seasonal strength."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.functions.scalar import ratio
from shelfspan.operators.joins import attach
from shelfspan.schemas import EPSILON


def first_sale_dates(df: DataFrame, target: str = "demand") -> DataFrame:
    """First date with positive demand per item; items never sold are absent."""
    return df.where(F.col(target) > 0).groupBy("item_id").agg(F.min("date").alias("first_sale"))


def add_item_age(df: DataFrame, target: str = "demand") -> DataFrame:
    """Days since the item's first sale; negative before it, 0 if never sold."""
    aged = attach(df, first_sale_dates(df, target), ["item_id"], spread_by=["store_id", "date"])
    return aged.withColumn("item_age_days", item_age()).drop("first_sale")


def item_age() -> F.Column:
    return F.datediff(F.col("date"), F.coalesce(F.col("first_sale"), F.col("date")))


def add_store_performance(df: DataFrame, target: str = "demand") -> DataFrame:
    """Demand relative to the item's mean over all stores on the same day."""
    means = df.groupBy("date", "item_id").agg(F.avg(target).alias("_mean"))
    joined = attach(df, means, ["date", "item_id"], spread_by=["store_id"])
    return joined.withColumn("store_performance", F.col(target) / (F.col("_mean") + EPSILON)).drop("_mean")


def add_competition(df: DataFrame) -> DataFrame:
    """Number of distinct items of the category in the store that day."""
    counts = df.groupBy("store_id", "cat_id", "date").agg(
        F.count_distinct("item_id").alias("category_competition")
    )
    return attach(df, counts, ["store_id", "cat_id", "date"], spread_by=["item_id"])


def monthly_strength(df: DataFrame, target: str = "demand") -> DataFrame:
    """Mean demand per item and month over the item's mean of monthly means."""
    monthly = df.groupBy("item_id", F.month("date").alias("_m")).agg(F.avg(target).alias("month_mean"))
    across = F.avg("month_mean").over(Window.partitionBy("item_id"))
    return monthly.withColumn("item_mean", across).withColumn(
        "seasonal_strength", ratio(F.col("month_mean"), F.col("item_mean"))
    )


def add_seasonal_strength(df: DataFrame, target: str = "demand") -> DataFrame:
    """Seasonal strength on every row; null for items that never sold."""
    strength = monthly_strength(df, target).select("item_id", "_m", "seasonal_strength")
    keyed = df.withColumn("_m", F.month("date"))
    return attach(keyed, strength, ["item_id", "_m"], spread_by=["store_id", "date"]).drop("_m")


def item_month_profile(df: DataFrame, target: str = "demand") -> DataFrame:
    """Everything the feature chain needs per item and month, from one pass.

    Mean price of the item and of its category, first sale date and seasonal
    strength. Windows run over the aggregate: twelve rows per item.
    """
    base = df.groupBy("item_id", "cat_id", F.month("date").alias("_m")).agg(
        F.sum("sell_price").alias("_ps"),
        F.count("sell_price").alias("_pn"),
        F.avg(target).alias("_month_mean"),
        F.min(F.when(F.col(target) > 0, F.col("date"))).alias("_first"),
    )
    item = Window.partitionBy("item_id")
    return base.select(
        "item_id",
        "cat_id",
        "_m",
        ratio(F.sum("_ps").over(item), F.sum("_pn").over(item)).alias("item_price_mean"),
        F.min("_first").over(item).alias("first_sale"),
        ratio(F.col("_month_mean"), F.avg("_month_mean").over(item)).alias("seasonal_strength"),
        F.col("_ps").alias("price_sum"),
        F.col("_pn").alias("price_count"),
    )
