"""A feature store that grows by days.

The store keeps the integrated columns beside the features, so new days need
nothing older than their look-back window: lags and rolling windows read the
last days of every series, smoothing goes on from the value stored with the
last day, and prices from the last known one. Months are partitions, and only
those from the first new day on are written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspan.operators import quality
from shelfspan.operators.demand import add_recursive_ewm
from shelfspan.operators.panel import series_window
from shelfspan.plans.features import store_features
from shelfspan.session import settle
from shelfspan.sources.tables import write_checked

LAGS, WINDOWS, SPANS = (1, 7, 14, 28), (7, 14, 28), (7, 28)
PERIOD, KNOWN = "period", "known_price"


def period_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def create_store(
    days: DataFrame, path: str, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS, spans: Sequence[int] = SPANS
) -> DataFrame:
    """Write the store of the given days; returns the rules counted while writing.

    ``days`` is the integrated panel: one row per series ``id`` and day, without
    gaps between the first and last day of a series.
    """
    return _write(_features(days, None, lags, windows, spans), path)


def append_days(
    days: DataFrame, path: str, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS, spans: Sequence[int] = SPANS
) -> DataFrame | None:
    """Add days to a store, or replace rows of days it has; returns the rules of what was written.

    Everything from the first given day on is computed again, as later features
    depend on it; of earlier days only the look-back window is read. A repeated
    append leaves the store as it was. Series must go on without gaps. Without
    rows nothing is written and None returned.
    """
    spark = days.sparkSession
    fresh = settle(days, "days")
    first = fresh.agg(F.min("date")).first()[0]
    if first is None:
        return None
    old = spark.read.parquet(path)
    start, back = F.lit(first), max(*lags, *windows)
    halo_start = F.date_sub(start, back)
    halo = old.where((F.col(PERIOD) >= period_of(halo_start)) & (F.col("date") >= halo_start) & (F.col("date") < start))
    from_first = old.where((F.col(PERIOD) >= period_of(start)) & (F.col("date") >= start))
    later = from_first.join(fresh.select("id", "date"), ["id", "date"], "left_anti")
    states = _states(spans)
    columns = fresh.columns
    none = {s: F.lit(None).cast("double") for s in states}
    before = halo.withColumns({"sell_price": F.col(KNOWN), **{s: F.col(c) for s, c in states.items()}}).select(*columns, *states)
    rows = fresh.unionByName(later.select(*columns)).withColumns(none).unionByName(before)
    result = _features(rows, first, lags, windows, spans)
    # The month of the first day is replaced as a whole, hence its earlier days are copied.
    copied = old.where((F.col(PERIOD) == period_of(start)) & (F.col("date") < start)).select(*result.columns)
    return _write(result.unionByName(copied), path, dynamic=True)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PERIOD, KNOWN)


def _states(spans: Sequence[int]) -> dict[str, str]:
    return {f"_state_{n}": f"demand_ewm_{n}" for n in spans}


def _features(rows: DataFrame, first, lags, windows, spans) -> DataFrame:
    """Features from the first new day on; all windows share the series and its order."""
    key = ["id"]
    df = store_features(rows, lags, windows)
    so_far = series_window(key).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn(KNOWN, F.last("sell_price", ignorenulls=True).over(so_far))
    if first is None:
        return add_recursive_ewm(df, spans, key).withColumn(PERIOD, period_of(F.col("date")))
    states = _states(spans)
    df = df.withColumns({s: F.last(s, ignorenulls=True).over(so_far) for s in states}).where(F.col("date") >= F.lit(first))
    df = add_recursive_ewm(df, spans, key).withColumns(
        {"_age": F.row_number().over(series_window(key)), "_first": F.first("demand").over(so_far)}
    )
    # Smoothing started anew differs from the one that goes on by the start's weight after so many days.
    carried = {}
    for n, (state, name) in zip(spans, states.items(), strict=True):
        weight = F.pow(F.lit(1.0 - 2.0 / (n + 1)), F.col("_age"))
        carried[name] = F.col(name) + F.coalesce(weight * (F.col(state) - F.col("_first")), F.lit(0.0))
    return df.withColumns(carried).drop(*states, "_age", "_first").withColumn(PERIOD, period_of(F.col("date")))


def _write(df: DataFrame, path: str, dynamic: bool = False) -> DataFrame:
    rules = quality.feature_store_rules(df.drop(PERIOD, KNOWN))
    # Rows of a month together, large months split, so that files are neither one per task and month nor huge.
    return write_checked(df.hint("rebalance", PERIOD), path, "feature_store", rules, by=[PERIOD], mode="overwrite" if dynamic else "error", dynamic=dynamic)
