"""Explicit schemas, keys and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("store_id", "item_id")
HIERARCHY = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
SALES_IDS = ("id", *HIERARCHY)

LAGS = (1, 7, 14, 21, 28, 35, 42)
WINDOWS = (7, 14, 28, 56)
ACTIVE_WINDOWS = (7, 14, 28)
PATTERN_WINDOWS = (14, 28, 56)
MOMENTUM_WINDOWS = (7, 14, 28)
EWM_ALPHAS = (0.1, 0.3, 0.5)
EWM_SPANS = (7, 14, 28, 56)
EPSILON = 1e-8
NEVER_SOLD_DAYS = 999
CALENDAR_TEXT = ("weekday", "event_name_1", "event_type_1", "event_name_2", "event_type_2")
EVENT_COLUMNS = CALENDAR_TEXT[1:]
SNAP_COLUMNS = ("snap_CA", "snap_TX", "snap_WI")
INDICATORS = ("UNRATE", "UMCSENT", "CPIAUCSL", "GDP", "GASREGW")


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def wide_sales(day_columns) -> T.StructType:
    """Six id columns followed by one integer column per day."""
    ids = [T.StructField(name, T.StringType()) for name in SALES_IDS]
    return T.StructType(ids + [T.StructField(day, T.IntegerType()) for day in day_columns])


CALENDAR = _struct(
    date=T.StringType(), wm_yr_wk=T.IntegerType(), weekday=T.StringType(), wday=T.IntegerType(),
    month=T.IntegerType(), year=T.IntegerType(), d=T.StringType(),
    event_name_1=T.StringType(), event_type_1=T.StringType(),
    event_name_2=T.StringType(), event_type_2=T.StringType(),
    snap_CA=T.IntegerType(), snap_TX=T.IntegerType(), snap_WI=T.IntegerType(),
)

PRICES = _struct(
    store_id=T.StringType(), item_id=T.StringType(), wm_yr_wk=T.IntegerType(), sell_price=T.DoubleType()
)

WEATHER_DAY = _struct(
    datetime=T.StringType(), tempmax=T.DoubleType(), tempmin=T.DoubleType(), temp=T.DoubleType(),
    humidity=T.DoubleType(), precip=T.DoubleType(), windspeed=T.DoubleType(),
    cloudcover=T.DoubleType(), conditions=T.StringType(),
)
WEATHER_PAYLOAD = _struct(state_id=T.StringType(), days=T.ArrayType(WEATHER_DAY))

OBSERVATION = _struct(date=T.StringType(), value=T.StringType())
ECONOMIC_PAYLOAD = _struct(series_id=T.StringType(), observations=T.ArrayType(OBSERVATION))
