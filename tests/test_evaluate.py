"""Forecast metrics on literal frames and metric identities."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspan.operators import evaluate as ev

SCHEMA = "store_id string, item_id string, cat_id string, date int, model string, y_true double, y_pred double"


def frame(spark, pairs, model="m"):
    return spark.createDataFrame([("S", "I", "C", n, model, float(t), float(p)) for n, (t, p) in enumerate(pairs)], SCHEMA)


PAIRS = [(0, 0), (0, 0.4), (2, 0), (4, 5), (10, 7)]


def test_metrics_on_five_rows(spark):
    row = ev.evaluate(frame(spark, PAIRS)).first()
    t, p = np.array(PAIRS, dtype=float).T
    assert row.rmse == pytest.approx(np.sqrt(np.mean((t - p) ** 2)))
    assert row.rmse**2 == pytest.approx(row.mse)
    assert row.r2 == pytest.approx(1 - ((t - p) ** 2).sum() / ((t - t.mean()) ** 2).sum())
    assert row.mape == pytest.approx(np.mean(np.abs(t - p)[t != 0] / t[t != 0]))
    assert row.error_std == pytest.approx(np.std(p - t))
    assert (row.zero_precision, row.zero_recall, row.zero_f1) == (0.5, 0.5, 0.5)
    assert row.demand_intensity_true == pytest.approx(16 / 3)


def test_undefined_metrics(spark):
    row = ev.evaluate(frame(spark, [(0, 1), (0, 2)])).first()
    assert math.isinf(row.mape) and row.nonzero_rmse == 0 and row.zero_f1 == 0 and row.demand_intensity_pred == 0
    assert row.r2 is None


def test_scaled_error_restarts_per_series(spark):
    df = spark.createDataFrame([("S", i, "C", n, "m", float(v), 0.0) for i in "ab" for n, v in enumerate([3, 3, 5])], SCHEMA)
    own, naive = (9 + 9 + 25) / 3, (9 + 0 + 4) / 3
    assert ev.scaled_error(df).first().rmsse == pytest.approx(math.sqrt(own / naive))
    assert math.isinf(ev.scaled_error(frame(spark, [(0, 1)])).first().rmsse)


def test_ks_against_direct_distribution_functions(spark):
    rng = np.random.default_rng(5)
    t, p = rng.integers(0, 6, 200), rng.integers(0, 9, 200)
    row = ev.ks_test(frame(spark, list(zip(t, p)))).first()
    grid = np.unique(np.concatenate([t, p]))
    gap = max(abs((t <= v).mean() - (p <= v).mean()) for v in grid)
    assert row.ks_statistic == pytest.approx(gap)
    assert 0 <= row.p_value < 0.05 and row.distributions_similar == 0
    same = ev.ks_test(frame(spark, list(zip(t, t)))).first()
    assert same.ks_statistic == 0 and same.p_value == 1 and same.distributions_similar == 1


def test_error_percentiles(spark):
    row = ev.error_percentiles(frame(spark, PAIRS)).first()
    t, p = np.array(PAIRS, dtype=float).T
    assert row.error_p25 == pytest.approx(np.percentile(p - t, 25))
    assert row.abs_error_p95 == pytest.approx(np.percentile(abs(p - t), 95))


def test_ranges_keep_the_maximum_unless_asked(spark):
    df = frame(spark, PAIRS)
    assert ev.rmse_by_range(df).agg(F.sum("n")).first()[0] == 5
    assert ev.rmse_by_range(df, keep_maximum=False).agg(F.sum("n")).first()[0] == 4
    assert ev.rmse_by_demand_level(df).agg(F.sum("n")).first()[0] == 3
    assert ev.rmse_by_demand_level(df, keep_maximum=False).agg(F.sum("n")).first()[0] == 2


def test_inventory_impact(spark):
    row = ev.inventory_impact(frame(spark, [(4, 4), (4, 0), (0, 2)])).first()
    assert row.total_holding_costs == pytest.approx(0.25 * 1 + 0.25 * 2.5)
    assert row.total_stockout_costs == pytest.approx(12)
    assert row.average_service_level == pytest.approx(0.5)
    assert (row.stockout_incidents, row.excess_inventory_incidents) == (1, 2)
    perfect = ev.inventory_impact(frame(spark, [(0, 0)])).first()
    assert perfect.cost_efficiency == 1 and perfect.average_service_level == 1


def test_value_of_naive_is_zero(spark):
    values = [3, 0, 2, 5]
    row = ev.forecast_value(frame(spark, list(zip(values, [0, *values[:-1]])))).first()
    assert row.cost_reduction == 0 and row.cost_reduction_pct == 0 and row.service_level_improvement == 0


def test_best_model(spark):
    df = spark.createDataFrame([("a", 2.0, 0.1), ("b", 1.0, 0.5)], "model string, rmse double, r2 double")
    assert ev.best_model(df).first().model == "b" and ev.best_model(df, "r2", largest=True).first().model == "b"


def test_f1_is_bounded(spark):
    rng = np.random.default_rng(0)
    pairs = list(zip(rng.integers(0, 3, 60), rng.integers(0, 3, 60)))
    row = ev._aggregate(frame(spark, pairs), ["model"], ev.zero_metrics()).first()
    assert 0 <= min(row.zero_precision, row.zero_recall) <= row.zero_f1 <= max(row.zero_precision, row.zero_recall) <= 1
