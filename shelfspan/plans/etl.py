"""Integration of all sources, and exploration and quality runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.operators import quality
from shelfspan.operators.joins import join_calendar, join_economic, join_prices, join_weather
from shelfspan.operators.panel import date_gaps
from shelfspan.plans.features import store_features
from shelfspan.session import settle
from shelfspan.sources.tables import write_checked


def integrate(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, weather: DataFrame | None = None, economic: DataFrame | None = None
) -> DataFrame:
    """Sales with calendar, price and, where given, weather and economic columns."""
    df = join_prices(join_calendar(sales, calendar), prices)
    if weather is not None:
        df = join_weather(df, weather)
    if economic is not None:
        df = join_economic(df, economic)
    return df


def build_feature_store(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, path: str, weather: DataFrame | None = None,
    economic: DataFrame | None = None, by: Sequence[str] = ("state_id",),
) -> DataFrame:
    """Integrate, add the compact features and write the store; returns its rules, counted while writing."""
    integrated = settle(integrate(sales, calendar, prices, weather, economic), "integrated")
    store = store_features(integrated)
    return write_checked(store, path, "feature_store", quality.feature_store_rules(store), by=by)


def check_core(
    sales: DataFrame, calendar: DataFrame, prices: DataFrame, expected_days: int = quality.DAY_COLUMNS,
    period: tuple[str, str] = quality.PERIOD,
) -> DataFrame:
    """All rules of the wide sales, calendar and price tables."""
    parts = [
        quality.run_rules(sales, "sales", quality.sales_rules(sales, expected_days)),
        quality.duplicate_rule(sales, "sales"),
        quality.run_rules(calendar, "calendar", quality.calendar_rules(calendar, period)),
        quality.run_rules(prices, "prices", quality.price_rules(prices)),
    ]
    if "date" in calendar.columns:
        days = calendar.select(F.col("date").cast("string").try_cast("date").alias("date")).dropna()
        parts.append(quality.gap_rule(date_gaps(days)))
    return _together(parts)


def check_external(weather: DataFrame | None, economic: DataFrame | None) -> DataFrame | None:
    """Rules of the weather and economic tables that are present."""
    parts = []
    if weather is not None:
        parts.append(quality.run_rules(weather, "weather", quality.weather_rules(weather)))
    if economic is not None:
        parts.append(quality.run_rules(economic, "economic", quality.economic_rules(economic)))
    return _together(parts) if parts else None


def check_store(store: DataFrame) -> DataFrame:
    return quality.run_rules(store, "feature_store", quality.feature_store_rules(store))


def _together(parts: Sequence[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
