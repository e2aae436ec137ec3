"""Lag, activity, rolling, exponentially weighted and intermittency features.

All columns share one window (series by date), so Spark plans one exchange and
one sort for them. The ``*_columns`` functions give the expressions, so a chain
can put many into a single window step. The panel must be dense.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.functions.scalar import flag
from shelfspan.operators.panel import series_window, trailing
from shelfspan.schemas import (
    ACTIVE_WINDOWS,
    EPSILON,
    EWM_ALPHAS,
    EWM_SPANS,
    LAGS,
    NEVER_SOLD_DAYS,
    PATTERN_WINDOWS,
    SERIES,
    WINDOWS,
)


def lag_columns(lags: Sequence[int] = LAGS, keys=SERIES, target="demand") -> dict[str, Column]:
    w = series_window(keys)
    return {f"{target}_lag_{n}": F.lag(target, n).over(w) for n in lags}


def lag_details(lags: Sequence[int] = LAGS, target="demand") -> dict[str, Column]:
    """log1p and non-zero flag of existing lag columns; an unknown lag is not non-zero."""
    extra = {}
    for n in lags:
        past = F.col(f"{target}_lag_{n}")
        extra[f"{target}_lag_{n}_log"] = F.log1p(past.cast("double"))
        extra[f"{target}_lag_{n}_nonzero"] = flag(past > 0)
    return extra


def add_lags(df: DataFrame, lags: Sequence[int] = LAGS, keys=SERIES, target="demand", detail=True) -> DataFrame:
    """Lagged demand; with ``detail`` also its log1p and a non-zero flag."""
    df = df.withColumns(lag_columns(lags, keys, target))
    return df.withColumns(lag_details(lags, target)) if detail else df


def activity_columns(windows: Sequence[int] = ACTIVE_WINDOWS, keys=SERIES, target="demand", shift=0) -> dict[str, Column]:
    sold = flag(F.col(target) > 0)
    return {f"active_days_last_{n}": F.sum(sold).over(trailing(n, keys, shift=shift)) for n in windows}


def add_activity(df: DataFrame, windows: Sequence[int] = ACTIVE_WINDOWS, keys=SERIES, target="demand", shift=0) -> DataFrame:
    """Number of days with sales among the last n days."""
    return df.withColumns(activity_columns(windows, keys, target, shift))


def rolling_columns(
    windows: Sequence[int] = WINDOWS, keys=SERIES, target="demand",
    stats: Sequence[str] = ("mean", "std", "max", "min"), shift: int = 0,
) -> dict[str, Column]:
    kinds = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    added = {}
    for n in windows:
        frame = trailing(n, keys, shift=shift)
        for stat in stats:
            added[f"{target}_rolling_{stat}_{n}"] = kinds[stat](target).over(frame)
    return added


def add_rolling(
    df: DataFrame, windows: Sequence[int] = WINDOWS, keys=SERIES, target="demand",
    stats: Sequence[str] = ("mean", "std", "max", "min"), shift: int = 0,
) -> DataFrame:
    """Rolling statistics over at least one row; std needs two."""
    return df.withColumns(rolling_columns(windows, keys, target, stats, shift))


def spread_columns(windows: Sequence[int] = WINDOWS, target="demand") -> dict[str, Column]:
    added = {}
    for n in windows:
        mean, std = F.col(f"{target}_rolling_mean_{n}"), F.col(f"{target}_rolling_std_{n}")
        added[f"{target}_rolling_cv_{n}"] = std / (mean + EPSILON)
        added[f"{target}_trend_{n}"] = (F.col(target) - mean) / (std + EPSILON)
    return added


def add_spread(df: DataFrame, windows: Sequence[int] = WINDOWS, target="demand") -> DataFrame:
    """Coefficient of variation and trend score from existing rolling columns."""
    return df.withColumns(spread_columns(windows, target))


def velocity_columns(pairs=((7, 14), (14, 28), (28, 56)), target="demand") -> dict[str, Column]:
    mean = f"{target}_rolling_mean_"
    return {f"demand_velocity_{a}_{b}": F.col(f"{mean}{a}") - F.col(f"{mean}{b}") for a, b in pairs}


def add_velocity(df: DataFrame, pairs=((7, 14), (14, 28), (28, 56)), target="demand") -> DataFrame:
    """Short minus long rolling mean."""
    return df.withColumns(velocity_columns(pairs, target))


def _block(kept: float) -> int:
    """Rows after which a value weighs less than double precision can see."""
    return math.ceil(40 / -math.log(kept))


def _passes(kept: dict[str, float]) -> list[dict[str, float]]:
    """Decays grouped so that rescaled values stay within a double inside the block of the slowest one."""
    passes: list[dict[str, float]] = []
    for name, q in sorted(kept.items(), key=lambda pair: -pair[1]):
        if passes and -math.log(q) * _block(max(passes[-1].values())) <= 690:
            passes[-1][name] = q
        else:
            passes.append({name: q})
    return passes


def _decayed_sums(df: DataFrame, alphas: dict[str, float], keys, target) -> DataFrame:
    """Add ``<name>``: sum over all earlier rows of target * (1-alpha)^age, and ``_row``.

    Decays that are far apart take one pass each; alpha 1 is the value itself.
    """
    df = df.withColumn("_row", F.row_number().over(series_window(keys)) - 1)
    itself = {name: F.coalesce(F.col(target).cast("double"), F.lit(0.0)) for name, a in alphas.items() if a >= 1}
    for kept in _passes({name: 1.0 - a for name, a in alphas.items() if a < 1}):
        df = _one_pass(df, kept, keys, target)
    return df.withColumns(itself) if itself else df


def _one_pass(df: DataFrame, kept: dict[str, float], keys, target) -> DataFrame:
    """The sums of one group of decays.

    The series is cut into blocks long enough that anything older than one
    full block weighs less than double precision can see. Inside a block a
    running sum of rescaled values does the work; the last finished block is
    carried over. Each row costs constant work for any alpha.
    """
    block = _block(max(kept.values()))
    df = df.withColumns({"_block": F.floor(F.col("_row") / block), "_pos": F.col("_row") % block})
    inside = Window.partitionBy(*keys, "_block").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    local = {
        f"_{name}_in": F.sum(F.col(target) * F.pow(F.lit(q), -F.col("_pos"))).over(inside)
        for name, q in kept.items()
    }
    df = df.withColumns(local)
    df = df.withColumns({f"_{name}_in": F.col(f"_{name}_in") * F.pow(F.lit(q), F.col("_pos")) for name, q in kept.items()})
    before = Window.partitionBy(*keys).orderBy("_block", "date").rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("_pos") == block - 1
    carried = {
        f"_{name}_end": F.last(F.when(done, F.col(f"_{name}_in")), ignorenulls=True).over(before) for name in kept
    }
    df = df.withColumns(carried)
    total = {
        name: F.col(f"_{name}_in") + F.coalesce(F.col(f"_{name}_end") * F.pow(F.lit(q), F.col("_pos") + 1), F.lit(0.0))
        for name, q in kept.items()
    }
    return df.withColumns(total).drop("_block", "_pos", *local, *carried)


def add_ewm(df: DataFrame, alphas: Sequence[float] = EWM_ALPHAS, keys=SERIES, target="demand") -> DataFrame:
    """Exponentially weighted mean with bias-adjusted weights."""
    names = {f"{target}_ewm_{str(a).replace('.', '_')}": a for a in alphas}
    df = _decayed_sums(df, names, keys, target)
    weighted = {}
    for name, a in names.items():
        weight = (1 - F.pow(F.lit(1.0 - a), F.col("_row") + 1)) / F.lit(a)
        weighted[name] = F.col(name) / weight
    return df.withColumns(weighted).drop("_row")


def add_recursive_ewm(df: DataFrame, spans: Sequence[int] = EWM_SPANS, keys=SERIES, target="demand") -> DataFrame:
    """Exponential smoothing by span, started from the first value."""
    names = {f"{target}_ewm_{n}": 2.0 / (n + 1) for n in spans}
    start = F.first(target).over(series_window(keys).rowsBetween(Window.unboundedPreceding, 0))
    df = _decayed_sums(df, names, keys, target).withColumn("_first", start)
    smoothed = {
        name: F.lit(a) * F.col(name) + F.pow(F.lit(1.0 - a), F.col("_row") + 1) * F.col("_first")
        for name, a in names.items()
    }
    return df.withColumns(smoothed).drop("_row", "_first")


def last_sale_before(keys=SERIES, target="demand", date="date") -> Column:
    """Date of the latest sale strictly before the row."""
    sold_on = F.when(F.col(target) > 0, F.col(date))
    return F.last(sold_on, ignorenulls=True).over(
        series_window(keys, date).rowsBetween(Window.unboundedPreceding, -1)
    )


def days_since_sale(keys=SERIES, target="demand", date="date") -> Column:
    gap = F.datediff(F.col(date), last_sale_before(keys, target, date))
    return F.coalesce(gap, F.lit(NEVER_SOLD_DAYS))


def add_days_since_sale(df: DataFrame, keys=SERIES, target="demand", date="date") -> DataFrame:
    """Days since the last sale, or a fixed large number before the first one."""
    return df.withColumn("days_since_last_sale", days_since_sale(keys, target, date))


def intermittency_columns(windows: Sequence[int] = PATTERN_WINDOWS, keys=SERIES, target="demand", shift=0) -> dict[str, Column]:
    y = F.col(target)
    added = {}
    for n in windows:
        frame = trailing(n, keys, shift=shift)
        added[f"intermittency_ratio_{n}"] = F.avg(flag(y == 0).cast("double")).over(frame)
        added[f"demand_intensity_{n}"] = F.coalesce(F.avg(F.when(y > 0, y)).over(frame), F.lit(0.0))
    return added


def add_intermittency(df: DataFrame, windows: Sequence[int] = PATTERN_WINDOWS, keys=SERIES, target="demand", shift=0) -> DataFrame:
    """Share of zero days, and mean demand of the selling days (else 0)."""
    return df.withColumns(intermittency_columns(windows, keys, target, shift))


def naive_forecast(keys=SERIES, target="demand") -> Column:
    """The previous value of the series, 0 for its first row."""
    return F.coalesce(F.lag(target).over(series_window(keys)), F.lit(0))


def mean_forecast(rows: int = 7, keys=SERIES, target="demand") -> Column:
    """Mean of the preceding rows, 0 for the first row."""
    return F.coalesce(F.avg(target).over(trailing(rows, keys, shift=1)), F.lit(0.0))
