"""Features from weather and economic signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import binned, flag
from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import percentile_columns
from shelfspan.operators.price import add_relative_change, full_frame_mean

# Bin edges and labels of the temperature and humidity categories.
TEMPERATURE_EDGES = (32, 50, 70, 85)
TEMPERATURE_LABELS = ("freezing", "cold", "mild", "warm", "hot")
TEMPERATURE_BINS = ("very_cold", "cold", "mild", "warm", "hot")
HUMIDITY_BINS = ("low", "medium", "high")


def derive_weather(df: DataFrame) -> DataFrame:
    """Temperature range, rain flag and temperature category."""
    return df.withColumns(
        {
            "temp_range": F.col("tempmax") - F.col("tempmin"),
            "is_rainy": flag(F.col("precip") > 0),
            "temp_category": binned(F.col("temp"), TEMPERATURE_EDGES, TEMPERATURE_LABELS),
        }
    )


def equal_width_edges(df: DataFrame, column: str, bins: int) -> list[F.Column]:
    """Inner edges of equal-width bins as scalar subqueries."""
    low, high = F.min(column), F.max(column)
    return [df.agg(low + (high - low) * i / bins).scalar() for i in range(1, bins)]


def add_weather_features(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Bins, seasonal delta and precipitation flags.

    ``source`` holds the rows the bin edges, averages and quantile come from;
    it defaults to the frame itself.
    """
    source = df if source is None else source
    rain = percentile_columns(source, "precip", {"p75": 0.75})
    seasonal = source.groupBy(F.month("date").alias("_m")).agg(F.avg("temp").alias("temp_seasonal_avg"))
    keyed = attach(df.withColumn("_m", F.month("date")), seasonal, ["_m"]).drop("_m")
    temp = F.col("temp")
    return keyed.withColumns(
        {
            "temp_squared": temp * temp,
            "temp_binned": binned(temp, equal_width_edges(source, "temp", 5), TEMPERATURE_BINS),
            "temp_relative_seasonal": temp - F.col("temp_seasonal_avg"),
            "humidity_binned": binned(F.col("humidity"), equal_width_edges(source, "humidity", 3), HUMIDITY_BINS),
            "has_precipitation": flag(F.col("precip") > 0),
            "heavy_rain": flag(F.col("precip") > rain.select("p75").scalar()),
        }
    )


def add_indicator_trends(df: DataFrame, columns: Sequence[str], keys: Sequence[str], periods: int = 12, rows: int = 3) -> DataFrame:
    """Year-over-year change and three-month mean, on the monthly table."""
    for c in columns:
        df = add_relative_change(df, f"{c}_trend", c, keys, periods=periods)
        df = df.withColumn(f"{c}_ma_{rows}", full_frame_mean(c, rows, keys))
    return df
