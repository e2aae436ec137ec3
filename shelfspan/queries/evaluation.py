"""Forecast evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import evaluate as ev
from shelfspan.operators.joins import spread_models
from shelfspan.plans import retail
from shelfspan.queries.base import cols, d, f, i, query, with_forecast
from shelfspan.session import settle

E = "(y_pred - y_true)"
FORECAST_KEYS = ["store_id", "item_id", "cat_id", "date"]


def forecast(spark, folder):
    return retail.forecast(spark, folder)


def grouped(*parts: str, by: str = "model", extra: str = "") -> str:
    return with_forecast(*([extra] if extra else [])) + f"SELECT {cols(by, *parts)} FROM forecast GROUP BY {by}"


RMSE = f"sqrt(AVG({E} * {E}))"
R2 = f"1 - SUM({E} * {E}) / nullif(VAR_POP(y_true) * COUNT(*), 0)"
MAPE = f"AVG(CASE WHEN y_true <> 0 THEN abs({E}) / abs(y_true) END)"
BASIC = {
    "rmse": RMSE, "mae": f"AVG(abs({E}))", "mse": f"AVG({E} * {E})", "r2": R2, "mape": MAPE,
    "mean_error": f"AVG({E})", "error_std": f"STDDEV_POP({E})",
}
BOTH = "COUNT(*) FILTER (WHERE y_true = 0 AND {z})"
PREDZ = "COUNT(*) FILTER (WHERE {z})"
TRUEZ = "COUNT(*) FILTER (WHERE y_true = 0)"


def zero_parts(z: str) -> dict[str, str]:
    both, pred = BOTH.format(z=z), PREDZ.format(z=z)
    precision = f"COALESCE({both} / nullif({pred}, 0)::DOUBLE, 0)"
    recall = f"COALESCE({both} / nullif({TRUEZ}, 0)::DOUBLE, 0)"
    f1 = f"CASE WHEN {precision} + {recall} > 0 THEN 2 * {precision} * {recall} / ({precision} + {recall}) ELSE 0 END"
    return {"zero_precision": precision, "zero_recall": recall, "zero_f1": f1}


RATE_TRUE = "AVG(CASE WHEN y_true = 0 THEN 1.0 ELSE 0.0 END)"
RATE_PRED = "AVG(CASE WHEN y_pred = 0 THEN 1.0 ELSE 0.0 END)"
NONZERO = {
    "nonzero_rmse": f"COALESCE(sqrt(AVG(CASE WHEN y_true > 0 THEN {E} * {E} END)), 0)",
    "nonzero_mae": f"COALESCE(AVG(CASE WHEN y_true > 0 THEN abs({E}) END), 0)",
}
RATES = {
    "intermittency_rate_true": RATE_TRUE, "intermittency_rate_pred": RATE_PRED,
    "intermittency_bias": f"{RATE_PRED} - {RATE_TRUE}",
}
INTENSITY = {
    "demand_intensity_true": "COALESCE(AVG(CASE WHEN y_true > 0 THEN y_true END), 0)",
    "demand_intensity_pred": "CASE WHEN COUNT(*) FILTER (WHERE y_true > 0) > 0 THEN COALESCE(AVG(CASE WHEN y_pred > 0 THEN y_pred END), 0) ELSE 0 END",
}
ALL = {**BASIC, **zero_parts("y_pred = 0"), **NONZERO, **RATES, **INTENSITY}


def fs(parts: dict[str, str]) -> list[str]:
    return [f(expr, name) for name, expr in parts.items()]



@query("e01_basic_errors", grouped(*fs({k: BASIC[k] for k in ("rmse", "mae", "mse", "r2")})))
def basic(spark, folder):
    m = ev.basic_metrics()
    return ev._aggregate(forecast(spark, folder), ["model"], {k: m[k] for k in ("rmse", "mae", "mse", "r2")})


@query("e02_mape", grouped(f(MAPE, "mape")))
def mape(spark, folder):
    return ev._aggregate(forecast(spark, folder), ["model"], {"mape": ev.basic_metrics()["mape"]})


@query("e03_bias_and_error_std", grouped(*fs({k: BASIC[k] for k in ("mean_error", "error_std")})))
def bias(spark, folder):
    m = ev.basic_metrics()
    return ev._aggregate(forecast(spark, folder), ["model"], {k: m[k] for k in ("mean_error", "error_std")})


NAIVE = """
naive_base AS (
  SELECT *, COALESCE(LAG(y_true) OVER (PARTITION BY model, store_id, item_id ORDER BY date), 0) AS naive FROM forecast)"""


@query(
    "e04_rmsse",
    with_forecast(NAIVE) + f"""SELECT {cols('model', f('v', 'rmsse'), f('v', 'rmse_scaled'))} FROM (
      SELECT model, sqrt(AVG({E} * {E}) / AVG((naive - y_true) * (naive - y_true))) AS v FROM naive_base GROUP BY model)""",
)
def rmsse(spark, folder):
    return ev.scaled_error(forecast(spark, folder))


@query("e05_zero_f1", grouped(*fs(zero_parts("y_pred = 0"))))
def zero_f1(spark, folder):
    return ev._aggregate(forecast(spark, folder), ["model"], ev.zero_metrics())


@query("e06_zero_f1_threshold", grouped(*fs(zero_parts("y_pred < 0.5"))))
def zero_f1_threshold(spark, folder):
    return ev._aggregate(forecast(spark, folder), ["model"], ev.zero_metrics(F.col("y_pred") < ev.ZERO_THRESHOLD))


def _more(names):
    def build(spark, folder):
        m = ev.intermittent_metrics()
        return ev._aggregate(forecast(spark, folder), ["model"], {k: m[k] for k in names})

    return build


query("e07_nonzero_errors", grouped(*fs(NONZERO)))(_more(list(NONZERO)))
query("e08_intermittency_rates", grouped(*fs(RATES)))(_more(list(RATES)))
query("e09_demand_intensity", grouped(*fs(INTENSITY)))(_more(list(INTENSITY)))

PCT = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


@query(
    "e10_error_percentiles",
    grouped(
        *[f(f"quantile_cont({E}, {p})", f"error_{n}") for n, p in PCT.items()],
        *[f(f"quantile_cont(abs({E}), {p})", f"abs_error_{n}") for n, p in PCT.items()],
    ),
)
def percentiles(spark, folder):
    return ev.error_percentiles(forecast(spark, folder))


@query(
    "e11_largest_errors",
    grouped(
        f(f"MIN({E})", "max_underestimation"), i(f"COUNT(*) FILTER (WHERE {E} < -2)", "underestimated"),
        f(f"MAX({E})", "max_overestimation"), i(f"COUNT(*) FILTER (WHERE {E} > 2)", "overestimated"),
    ),
)
def largest(spark, folder):
    return ev.largest_errors(forecast(spark, folder))


def _side(side: str, c: str) -> list[str]:
    return [
        f(f"AVG({c})", f"{side}_mean"), f(f"STDDEV_POP({c})", f"{side}_std"), f(f"MIN({c})", f"{side}_min"),
        f(f"MAX({c})", f"{side}_max"), i(f"COUNT(*) FILTER (WHERE {c} = 0)", f"{side}_zeros"),
        i(f"COUNT(*) FILTER (WHERE {c} > 0)", f"{side}_positive"),
    ]


@query("e12_distribution_stats", grouped(*_side("actual", "y_true"), *_side("predicted", "y_pred")))
def distributions(spark, folder):
    return ev.distribution_stats(forecast(spark, folder))


KS = """
sides AS (SELECT model, y_true AS v, 1 AS a, 0 AS b FROM forecast UNION ALL SELECT model, y_pred, 0, 1 FROM forecast),
counts AS (SELECT model, v, SUM(a) AS a, SUM(b) AS b FROM sides GROUP BY model, v),
cum AS (SELECT model, SUM(a) OVER (PARTITION BY model ORDER BY v) / SUM(a) OVER (PARTITION BY model) AS fa,
               SUM(b) OVER (PARTITION BY model ORDER BY v) / SUM(b) OVER (PARTITION BY model) AS fb,
               SUM(a) OVER (PARTITION BY model) AS na, SUM(b) OVER (PARTITION BY model) AS nb FROM counts),
stat AS (SELECT model, MAX(abs(fa - fb)) AS ks, MAX(na)::DOUBLE AS na, MAX(nb)::DOUBLE AS nb FROM cum GROUP BY model),
prob AS (SELECT model, ks, CASE WHEN ks * sqrt(na * nb / (na + nb)) < 0.2 THEN 1.0 ELSE
           least(greatest(list_sum([(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * ks * ks * na * nb / (na + nb))
                                    FOR k IN range(1, 101)]), 0), 1) END AS p FROM stat)"""


@query(
    "e13_ks_test",
    with_forecast(KS) + f"SELECT {cols('model', f('ks', 'ks_statistic'), f('p', 'p_value'), i('CASE WHEN p > 0.05 THEN 1 ELSE 0 END', 'distributions_similar'))} FROM prob",
)
def ks(spark, folder):
    return ev.ks_test(forecast(spark, folder))


@query("e14_metrics_by_category", grouped(i("COUNT(*)", "n_samples"), f(RATE_TRUE, "zero_rate"), *fs(ALL), by="model, cat_id"))
def by_category(spark, folder):
    return ev.evaluate_by_category(forecast(spark, folder))


@query(
    "e15_model_comparison",
    grouped(
        *[f(ALL[k], k, 4) for k in ("rmse", "mae", "r2", "mape", "zero_f1", "nonzero_rmse")],
        f(RATE_PRED, "zero_rate_pred", 4), f(RATE_TRUE, "zero_rate_true", 4),
    ),
)
def comparison(spark, folder):
    return ev.compare_models(forecast(spark, folder))


@query(
    "e16_zero_confusion",
    with_forecast() + f"""SELECT {cols('model', i('CASE WHEN y_true = 0 THEN 1 ELSE 0 END', 'true_zero'),
      i('CASE WHEN y_pred = 0 THEN 1 ELSE 0 END', 'pred_zero'), i('COUNT(*)', 'n'))} FROM forecast GROUP BY 1, 2, 3""",
)
def confusion(spark, folder):
    return ev.confusion(forecast(spark, folder))


@query(
    "e17_rmse_by_range",
    with_forecast() + f"""SELECT {cols('model', i('least(floor(y_true / (top / 10)), 9)', 'bin'), f(RMSE, 'rmse'), i('COUNT(*)', 'n'))}
      FROM forecast CROSS JOIN (SELECT MAX(y_true) AS top FROM forecast) GROUP BY 1, 2""",
)
def by_range(spark, folder):
    return ev.rmse_by_range(forecast(spark, folder))


LEVELS = """
edges AS (SELECT quantile_cont(y_true, [0, 0.25, 0.5, 0.75, 0.9, 1.0]) AS q FROM forecast WHERE y_true > 0),
leveled AS (
  SELECT f.*, CASE WHEN y_true = q[6] THEN 4 WHEN y_true >= q[5] THEN 4 WHEN y_true >= q[4] THEN 3
                   WHEN y_true >= q[3] THEN 2 WHEN y_true >= q[2] THEN 1 ELSE 0 END AS level
  FROM forecast f CROSS JOIN edges WHERE y_true > 0)"""


@query(
    "e18_rmse_by_demand_level",
    with_forecast(LEVELS) + f"SELECT {cols('model', i('level'), f(RMSE, 'rmse'), i('COUNT(*)', 'n'))} FROM leveled GROUP BY model, level",
)
def by_level(spark, folder):
    return ev.rmse_by_demand_level(forecast(spark, folder))


def inventory_parts(p: str) -> dict[str, str]:
    excess = f"greatest({p} * 1.25 - y_true, 0)"
    short = f"greatest(y_true - {p} * 1.25, 0)"
    total = f"SUM({excess} * 0.25 + {short} * 3.0)"
    best = "SUM(greatest(y_true * 1.25 - y_true, 0) * 0.25)"
    return {
        "total_holding_costs": f"SUM({excess} * 0.25)",
        "total_stockout_costs": f"SUM({short} * 3.0)",
        "total_costs": total,
        "optimal_costs": best,
        "cost_efficiency": f"CASE WHEN {total} > 0 THEN {best} / {total} ELSE 1.0 END",
        "average_service_level": f"COALESCE(AVG(CASE WHEN y_true > 0 THEN least({p} * 1.25 / greatest(y_true, 1e-8), 1.0) END), 1.0)",
        "stockout_incidents": f"COUNT(*) FILTER (WHERE {short} > 0)",
        "excess_inventory_incidents": f"COUNT(*) FILTER (WHERE {excess} > 0)",
    }


INVENTORY = inventory_parts("y_pred")


@query(
    "e19_inventory_impact",
    grouped(*[i(x, k) if k.endswith("incidents") else f(x, k, 4) for k, x in INVENTORY.items()]),
    digits=4,
)
def inventory(spark, folder):
    return ev.inventory_impact(forecast(spark, folder))


OWN, BASE = inventory_parts("y_pred"), inventory_parts("naive")


@query(
    "e20_forecast_value",
    with_forecast(NAIVE, f"""
costs AS (SELECT model, {OWN['total_costs']} AS own, {BASE['total_costs']} AS base,
                 {OWN['average_service_level']} AS own_level, {BASE['average_service_level']} AS base_level
          FROM naive_base GROUP BY model)""")
    + f"""SELECT {cols('model', f('base - own', 'cost_reduction', 4), f('(base - own) / base * 100', 'cost_reduction_pct', 4),
      f('own_level - base_level', 'service_level_improvement', 4), f('base - own', 'roi_estimate', 4),
      f('base', 'baseline_costs', 4), f('own', 'model_costs', 4))} FROM costs""",
    digits=4,
)
def value(spark, folder):
    return ev.forecast_value(forecast(spark, folder))


@query(
    "e21_simple_record",
    grouped(f(RMSE, "rmse"), f(BASIC["mae"], "mae"), f(R2, "r2"), f(zero_parts("y_pred < 0.5")["zero_f1"], "zero_f1"),
            f(RATE_TRUE, "zero_rate_actual"), f(RATE_PRED, "zero_rate_predicted")),
)
def record(spark, folder):
    return ev.simple_record(forecast(spark, folder))


@query("e_full_evaluation", grouped(i("COUNT(*)", "n_samples"), *fs(ALL)))
def full(spark, folder):
    return ev.evaluate(forecast(spark, folder))


METRIC_TABLE = with_forecast(f"""
metrics AS (SELECT model, {RMSE} AS rmse, {BASIC['mae']} AS mae, {R2} AS r2 FROM forecast GROUP BY model)""")


@query("t04_best_model", METRIC_TABLE + f"SELECT arg_min(model, rmse) AS by_rmse, arg_max(model, r2) AS by_r2, {f('MIN(rmse)', 'rmse')} FROM metrics")
def best(spark, folder):
    metrics = settle(ev.evaluate(forecast(spark, folder)).select("model", "rmse", "r2"), "metrics")
    by_rmse = ev.best_model(metrics).withColumnRenamed("model", "by_rmse")
    return by_rmse.withColumn("by_r2", ev.best_model(metrics, "r2", largest=True).select("model").scalar())


@query("t05_models_by_rmse", METRIC_TABLE + f"SELECT {cols('model', f('rmse'), i('row_number() OVER (ORDER BY rmse, model)', 'place'))} FROM metrics")
def ordered(spark, folder):
    from pyspark.sql import Window

    metrics = ev.evaluate(forecast(spark, folder)).select("model", "rmse")
    return metrics.withColumn("place", F.row_number().over(Window.orderBy("rmse", "model")))


@query(
    "e_metric_rows",
    METRIC_TABLE + f"SELECT model, metric, {f('value')} FROM metrics UNPIVOT (value FOR metric IN (rmse, mae, r2))",
)
def metric_rows(spark, folder):
    return ev.metric_rows(ev.evaluate(forecast(spark, folder)).select("model", "rmse", "mae", "r2"))


ALIGNED = with_forecast("""
aligned AS (SELECT a.store_id, a.item_id, a.cat_id, a.date, a.y_pred AS naive, b.y_pred AS ma7
            FROM forecast a JOIN forecast b ON a.store_id = b.store_id AND a.item_id = b.item_id AND a.date = b.date
            WHERE a.model = 'naive' AND b.model = 'ma7')""")


def aligned(spark, folder):
    return spread_models(forecast(spark, folder), ["naive", "ma7"], FORECAST_KEYS)


@query("j13_align_forecasts", ALIGNED + f"SELECT {cols('store_id', 'item_id', 'cat_id', d('date'), f('naive'), f('ma7'))} FROM aligned")
def align(spark, folder):
    return aligned(spark, folder)


@query("m06_weighted_ensemble", ALIGNED + f"SELECT {cols('store_id', 'item_id', d('date'), f('(0.4 * naive + 0.3 * ma7) / (0.4 + 0.3)', 'y_pred'))} FROM aligned")
def ensemble(spark, folder):
    from shelfspan.operators.models import weighted_mean

    weights = {"naive": 0.4, "ma7": 0.3, "absent": 0.3}
    return aligned(spark, folder).select("store_id", "item_id", "date", weighted_mean(["naive", "ma7"], weights).alias("y_pred"))


@query(
    "m07_clamped_prediction",
    with_forecast() + f"SELECT {cols('model', 'store_id', 'item_id', d('date'), f('greatest(2 * y_pred - 20, 0)', 'y_pred'))} FROM forecast",
)
def clamp(spark, folder):
    from shelfspan.operators.models import non_negative

    return forecast(spark, folder).select("model", "store_id", "item_id", "date", non_negative(2 * F.col("y_pred") - 20).alias("y_pred"))
