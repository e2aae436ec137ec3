"""Forecast metrics over one frame ``(series, date, cat_id, model, y_true, y_pred)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import bin_number, flag
from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import exact_percentiles, percentile_columns, running_totals
from shelfspan.operators.panel import series_window
from shelfspan.schemas import EPSILON, SERIES

# Inventory cost parameters.
SAFETY_FACTOR = 1.25
HOLDING_RATE = 0.25
STOCKOUT_MULTIPLIER = 3.0
LARGE_ERROR = 2
SIMILARITY_LEVEL = 0.05
ERROR_PERCENTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
DEMAND_QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
ZERO_THRESHOLD = 0.5


def _t() -> Column:
    return F.col("y_true")


def _p() -> Column:
    return F.col("y_pred")


def _e() -> Column:
    return F.col("y_pred") - F.col("y_true")


def basic_metrics() -> dict[str, Column]:
    """rmse, mae, mse, r2, mape (fraction), bias and its population deviation."""
    sse = F.sum(_e() * _e())
    sst = F.var_pop(_t()) * F.count(_t())
    share = F.avg(F.when(_t() != 0, F.abs(_e()) / F.abs(_t())))
    return {
        "rmse": F.sqrt(F.avg(_e() * _e())),
        "mae": F.avg(F.abs(_e())),
        "mse": F.avg(_e() * _e()),
        "r2": 1 - F.try_divide(sse, sst),
        "mape": F.coalesce(share, F.lit(float("inf"))),
        "mean_error": F.avg(_e()),
        "error_std": F.stddev_pop(_e()),
    }


def zero_metrics(is_zero: Column | None = None) -> dict[str, Column]:
    """Precision, recall and F1 of predicting no demand; 0 where undefined."""
    guess = _p() == 0 if is_zero is None else is_zero
    both = F.count_if((_t() == 0) & guess)
    guessed, actual = F.count_if(guess), F.count_if(_t() == 0)
    zero = F.lit(0.0)
    return {
        "zero_precision": F.coalesce(F.try_divide(both, guessed), zero),
        "zero_recall": F.coalesce(F.try_divide(both, actual), zero),
        "zero_f1": F.coalesce(F.try_divide(2 * both, guessed + actual), zero),
    }


def intermittent_metrics() -> dict[str, Column]:
    """Non-zero errors, intermittency rates and demand intensities."""
    sold = _t() > 0
    zero = F.lit(0.0)
    rate_true = F.avg(flag(_t() == 0).cast("double"))
    rate_pred = F.avg(flag(_p() == 0).cast("double"))
    intensity_pred = F.when(F.count_if(sold) > 0, F.avg(F.when(_p() > 0, _p())))
    return {
        "nonzero_rmse": F.coalesce(F.sqrt(F.avg(F.when(sold, _e() * _e()))), zero),
        "nonzero_mae": F.coalesce(F.avg(F.when(sold, F.abs(_e()))), zero),
        "intermittency_rate_true": rate_true,
        "intermittency_rate_pred": rate_pred,
        "intermittency_bias": rate_pred - rate_true,
        "demand_intensity_true": F.coalesce(F.avg(F.when(sold, _t())), zero),
        "demand_intensity_pred": F.coalesce(intensity_pred, zero),
    }


def _aggregate(df: DataFrame, by: Sequence[str], metrics: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in metrics.items()])


def evaluate(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """All single-pass metrics per group."""
    counts = {"n_samples": F.count(F.lit(1))}
    return _aggregate(df, by, {**counts, **basic_metrics(), **zero_metrics(), **intermittent_metrics()})


def evaluate_by_category(df: DataFrame, by: Sequence[str] = ("model", "cat_id")) -> DataFrame:
    """The same metrics per model and category, with the zero rate."""
    extra = {"n_samples": F.count(F.lit(1)), "zero_rate": F.avg(flag(_t() == 0).cast("double"))}
    return _aggregate(df, by, {**extra, **basic_metrics(), **zero_metrics(), **intermittent_metrics()})


def scaled_error(df: DataFrame, by: Sequence[str] = ("model",), keys: Sequence[str] = SERIES) -> DataFrame:
    """RMSE relative to the previous-value forecast of each series."""
    previous = F.coalesce(F.lag("y_true").over(series_window([*by, *keys])), F.lit(0.0))
    base = df.withColumn("_naive", previous)
    own = F.avg(_e() * _e())
    naive = F.avg((F.col("_naive") - _t()) * (F.col("_naive") - _t()))
    value = F.coalesce(F.sqrt(F.try_divide(own, naive)), F.lit(float("inf")))
    return base.groupBy(*by).agg(value.alias("rmsse")).withColumn("rmse_scaled", F.col("rmsse"))


def error_percentiles(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Percentiles of signed and absolute errors."""
    both = df.select(*by, _e().alias("error"), F.abs(_e()).alias("abs_error"))
    rows = exact_percentiles(both, ["error", "abs_error"], list(ERROR_PERCENTILES.values()), by)
    picks = [
        F.max(F.when((F.col("column") == kind) & (F.col("p") == p), F.col("value"))).alias(f"{kind}_{name}")
        for kind in ("error", "abs_error")
        for name, p in ERROR_PERCENTILES.items()
    ]
    return rows.groupBy(*by).agg(*picks)


def largest_errors(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Extreme errors and how often they pass the limit either way."""
    return _aggregate(
        df, by,
        {
            "max_underestimation": F.min(_e()),
            "underestimated": F.count_if(_e() < -LARGE_ERROR),
            "max_overestimation": F.max(_e()),
            "overestimated": F.count_if(_e() > LARGE_ERROR),
        },
    )


def distribution_stats(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean, population deviation, extremes, zeros and positives of both sides."""
    metrics = {}
    for side, c in (("actual", _t()), ("predicted", _p())):
        metrics.update(
            {
                f"{side}_mean": F.avg(c), f"{side}_std": F.stddev_pop(c), f"{side}_min": F.min(c), f"{side}_max": F.max(c),
                f"{side}_zeros": F.count_if(c == 0), f"{side}_positive": F.count_if(c > 0),
            }
        )
    return _aggregate(df, by, metrics)


def ks_test(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic with its asymptotic p-value.

    Both samples are counted per value, the counts are accumulated in global
    order, and the largest gap of the two distribution functions is taken.
    """
    by = list(by)
    sides = df.select(*by, F.explode(F.array(
        F.struct(_t().alias("value"), F.lit(1).alias("a"), F.lit(0).alias("b")),
        F.struct(_p().alias("value"), F.lit(0).alias("a"), F.lit(1).alias("b")),
    )).alias("s"))
    counts = sides.groupBy(*by, "s.value").agg(F.sum("s.a").alias("a"), F.sum("s.b").alias("b"))
    ranked = running_totals(counts, [*by, "value"], ["a", "b"])
    groups = ranked.groupBy(*by).agg(
        F.min("a_before").alias("_a0"), F.min("b_before").alias("_b0"), F.sum("a").alias("_na"), F.sum("b").alias("_nb")
    )
    placed = attach(ranked, groups, by, spread_by=["value"])
    upto_a = (F.col("a_before") - F.col("_a0") + F.col("a")) / F.col("_na")
    upto_b = (F.col("b_before") - F.col("_b0") + F.col("b")) / F.col("_nb")
    stats = placed.groupBy(*by).agg(
        F.max(F.abs(upto_a - upto_b)).alias("ks_statistic"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb")
    )
    scale = F.sqrt(F.col("_na").cast("double") * F.col("_nb") / (F.col("_na") + F.col("_nb")))
    x = F.col("ks_statistic") * scale
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * k * k * x * x),
    )
    p_value = F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(terms, F.lit(0.0)), F.lit(1.0)))
    return stats.select(
        *by, "ks_statistic", p_value.alias("p_value"), (p_value > SIMILARITY_LEVEL).cast("int").alias("distributions_similar")
    )


def compare_models(df: DataFrame) -> DataFrame:
    """Model comparison table rounded to four places."""
    zero = zero_metrics()
    basic = basic_metrics()
    more = intermittent_metrics()
    picked = {
        "rmse": basic["rmse"], "mae": basic["mae"], "r2": basic["r2"], "mape": basic["mape"], "zero_f1": zero["zero_f1"],
        "nonzero_rmse": more["nonzero_rmse"], "zero_rate_pred": more["intermittency_rate_pred"],
        "zero_rate_true": more["intermittency_rate_true"],
    }
    return _aggregate(df, ["model"], {name: F.round(c, 4) for name, c in picked.items()})


def simple_record(df: DataFrame, by: Sequence[str] = ("model",), threshold: float = ZERO_THRESHOLD) -> DataFrame:
    """The short record of a model: four metrics and both zero rates."""
    basic = basic_metrics()
    f1 = zero_metrics(_p() < threshold)["zero_f1"]
    more = intermittent_metrics()
    return _aggregate(
        df, by,
        {
            "rmse": basic["rmse"], "mae": basic["mae"], "r2": basic["r2"], "zero_f1": f1,
            "zero_rate_actual": more["intermittency_rate_true"], "zero_rate_predicted": more["intermittency_rate_pred"],
        },
    )


def confusion(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Counts by whether truth and prediction are zero."""
    keys = [*by, flag(_t() == 0).alias("true_zero"), flag(_p() == 0).alias("pred_zero")]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def rmse_by_range(df: DataFrame, bins: int = 10, by: Sequence[str] = ("model",), keep_maximum: bool = True) -> DataFrame:
    """RMSE in equal-width ranges of the actual value, from zero to its maximum.

    The top value belongs to the last range; with ``keep_maximum=False`` it is
    left out, as left-closed ranges would have it.
    """
    top = df.agg(F.max("y_true")).scalar()
    kept = df.withColumn("_top", top)
    if not keep_maximum:
        kept = kept.where(_t() < F.col("_top"))
    number = bin_number(_t(), F.lit(0.0), F.col("_top") / bins, bins)
    return kept.groupBy(*by, number.alias("bin")).agg(
        F.sqrt(F.avg(_e() * _e())).alias("rmse"), F.count(F.lit(1)).alias("n")
    )


def rmse_by_demand_level(df: DataFrame, by: Sequence[str] = ("model",), keep_maximum: bool = True) -> DataFrame:
    """RMSE between quantiles of the positive actual values."""
    positive = df.where(_t() > 0)
    names = {f"q{n}": q for n, q in enumerate(DEMAND_QUANTILES)}
    edges = percentile_columns(positive, "y_true", names)
    bound = [edges.select(name).scalar() for name in names]
    last = len(bound) - 1
    level = F.lit(None).cast("int")
    for n in range(last):
        inside = (_t() >= bound[n]) & (_t() < bound[n + 1])
        level = F.when(inside, n).otherwise(level)
    if keep_maximum:
        level = F.when(_t() == bound[last], last - 1).otherwise(level)
    return positive.withColumn("level", level).where(F.col("level").isNotNull()).groupBy(*by, "level").agg(
        F.sqrt(F.avg(_e() * _e())).alias("rmse"), F.count(F.lit(1)).alias("n")
    )


def inventory_metrics(
    forecast: Column, factor: float = SAFETY_FACTOR, holding: float = HOLDING_RATE, stockout: float = STOCKOUT_MULTIPLIER
) -> dict[str, Column]:
    """Holding and stockout costs of stocking a forecast with a safety factor."""
    stock = forecast * factor
    excess = F.greatest(stock - _t(), F.lit(0.0))
    short = F.greatest(_t() - stock, F.lit(0.0))
    best = F.greatest(_t() * factor - _t(), F.lit(0.0)) * holding
    held, missed = F.sum(excess * holding), F.sum(short * stockout)
    total = F.sum(excess * holding + short * stockout)
    served = F.least(stock / F.greatest(_t(), F.lit(EPSILON)), F.lit(1.0))
    return {
        "total_holding_costs": held,
        "total_stockout_costs": missed,
        "total_costs": total,
        "optimal_costs": F.sum(best),
        "cost_efficiency": F.when(total > 0, F.try_divide(F.sum(best), total)).otherwise(1.0),
        "average_service_level": F.coalesce(F.avg(F.when(_t() > 0, served)), F.lit(1.0)),
        "stockout_incidents": F.count_if(short > 0),
        "excess_inventory_incidents": F.count_if(excess > 0),
    }


def inventory_impact(df: DataFrame, by: Sequence[str] = ("model",), factor: float = SAFETY_FACTOR) -> DataFrame:
    return _aggregate(df, by, inventory_metrics(_p(), factor))


def forecast_value(
    df: DataFrame, by: Sequence[str] = ("model",), keys: Sequence[str] = SERIES, baseline: str | None = None
) -> DataFrame:
    """Cost and service gain over a baseline, by default the previous value."""
    if baseline is None:
        baseline = "_baseline"
        previous = F.coalesce(F.lag("y_true").over(series_window([*by, *keys])), F.lit(0.0))
        df = df.withColumn(baseline, previous)
    own = inventory_metrics(_p())
    base = inventory_metrics(F.col(baseline))
    both = df.groupBy(*by).agg(
        own["total_costs"].alias("model_costs"), base["total_costs"].alias("baseline_costs"),
        own["average_service_level"].alias("_own"), base["average_service_level"].alias("_base"),
    )
    saved = F.col("baseline_costs") - F.col("model_costs")
    return both.select(
        *by, saved.alias("cost_reduction"),
        F.coalesce(F.try_divide(saved, F.col("baseline_costs")) * 100, F.lit(0.0)).alias("cost_reduction_pct"),
        (F.col("_own") - F.col("_base")).alias("service_level_improvement"), saved.alias("roi_estimate"),
        "baseline_costs", "model_costs",
    )


def best_model(metrics: DataFrame, metric: str = "rmse", largest: bool = False) -> DataFrame:
    """The model with the lowest (or highest) value of a metric."""
    pick = F.max_by if largest else F.min_by
    return metrics.agg(pick("model", metric).alias("model"), (F.max if largest else F.min)(metric).alias(metric))


def metric_rows(metrics: DataFrame, ids: Sequence[str] = ("model",)) -> DataFrame:
    """Metric columns as rows ``(ids, metric, value)``."""
    names = [c for c in metrics.columns if c not in ids]
    numbers = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in names])
    return numbers.unpivot(list(ids), names, "metric", "value")
