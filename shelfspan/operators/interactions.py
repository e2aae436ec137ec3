"""Products and combined categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import joined_text


def price_interactions(holiday: str = "has_any_event") -> dict[str, Column]:
    price = F.col("sell_price")
    return {
        "price_month_interaction": price * F.col("month"),
        "price_weekend_interaction": price * F.col("is_weekend"),
        "price_holiday_interaction": price * F.col(holiday),
        "lag7_price_interaction": F.col("demand_lag_7") * price,
    }


def add_price_interactions(df: DataFrame, holiday: str = "has_any_event") -> DataFrame:
    """Price by month, weekend and event day, and by last week's demand."""
    return df.withColumns(price_interactions(holiday))


def code_interactions() -> dict[str, Column]:
    """Month by category code and weekday by store code."""
    return {
        "month_cat_interaction": F.col("month") * F.col("cat_id_encoded"),
        "dow_store_interaction": F.col("dayofweek") * F.col("store_id_encoded"),
    }


def price_elasticity() -> Column:
    """Fractional price change times demand a week ago; unknown counts as zero."""
    return F.coalesce(F.col("price_change_pct"), F.lit(0.0)) * F.coalesce(F.col("demand_lag_7"), F.lit(0))


SEASON_COMBINATIONS = {
    "cat_month": ("cat_id", "month"),
    "cat_quarter": ("cat_id", "quarter"),
    "store_month": ("store_id", "month"),
    "store_quarter": ("store_id", "quarter"),
    "weekend_cat": ("is_weekend", "cat_id"),
}

HIERARCHY_COMBINATIONS = {
    "state_cat_combined": ("state_id", "cat_id"),
    "store_cat_combined": ("store_id", "cat_id"),
    "store_dept_combined": ("store_id", "dept_id"),
}


def add_combinations(df: DataFrame, combinations: dict[str, tuple[str, ...]]) -> DataFrame:
    return df.withColumns({name: joined_text(*parts) for name, parts in combinations.items()})
