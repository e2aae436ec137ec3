"""Model queries. Training is iterative, so most have no SQL to compare with.

Every model trains on the whole history of the panel; the tree counts are small
here because they are parameters, not part of the data.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from shelfspan.operators import evaluate as ev
from shelfspan.operators import models as m
from shelfspan.operators.ordering import top_k
from shelfspan.operators.splits import expanding_folds, rolling_origin_folds
from shelfspan.plans import retail, training
from shelfspan.queries.base import cols, d, f, query, with_panel
from shelfspan.session import settle, shared_path
from shelfspan.sources.tables import append_run

TREES, DEPTH = 5, 4


def frame(spark, folder):
    return settle(training.training_frame(retail.panel(spark, folder)), "training")


def record(spark, folder, name, estimator):
    _, _, metrics = training.compare(frame(spark, folder), {name: estimator})
    return metrics.where(F.col("model") == name)


@query("m01_boosted_trees")
def boosted(spark, folder):
    return record(spark, folder, "boosted", m.boosted_trees(TREES, DEPTH))


@query("m02_early_stopping")
def early_stopping(spark, folder):
    """Training and validation rows together; the flag marks the validation rows."""
    data, _ = training.matrix(frame(spark, folder))
    flagged = data.withColumn("is_valid", F.col("split") == "valid")
    model = m.boosted_trees(TREES, DEPTH, rate=0.3, validation="is_valid").fit(flagged.where(F.col("split") != "test"))
    forecasts = m.forecast_frame(m.score({"early": model}, data.where(F.col("split") == "test")), ["early"], training.KEYS)
    return ev.simple_record(forecasts).withColumn("trees_kept", F.lit(model.getNumTrees))


@query("m03_poisson")
def poisson(spark, folder):
    return record(spark, folder, "poisson", m.count_model("poisson"))


@query("m03_tweedie")
def tweedie(spark, folder):
    return record(spark, folder, "tweedie", m.count_model("tweedie", 1.1))


@query("m04_random_forest")
def forest(spark, folder):
    return record(spark, folder, "forest", m.random_forest(TREES, DEPTH))


@query("m05_seasonal_trend")
def seasonal(spark, folder):
    """Fitted per category on all but the last 28 days, predicted for every row."""
    panel = settle(retail.panel(spark, folder).select(*training.KEYS, "demand"), "panel")
    start, end = panel.agg(F.min("date")).scalar(), panel.agg(F.max("date")).scalar()
    fitted = m.fit_seasonal(panel.where(F.datediff(end, F.col("date")) >= 28), "cat_id", start)
    return m.predict_seasonal(panel, fitted, "cat_id", start)


SPACE = {"trees": (2, 4), "depth": (2, 4), "rate": (0.05, 0.3, "log")}


def folded(spark, folder, make_folds):
    data, _ = training.matrix(frame(spark, folder))
    return make_folds(data.select(*training.KEYS, "demand", "features"), 2)


@query("m09_random_search")
def random_search(spark, folder):
    return m.search(m.boosted_trees, m.sampled(SPACE, 2), folded(spark, folder, expanding_folds), 2)


@query("m10_grid_search")
def grid_search(spark, folder):
    candidates = m.grid({"trees": [3], "depth": [2, 4]})
    results = m.search(m.random_forest, candidates, folded(spark, folder, rolling_origin_folds), 2)
    return m.best_candidate(results)


def two(trees=TREES):
    return {"xgboost": m.boosted_trees(trees, 3), "random_forest": m.random_forest(trees, 4)}


@query("m06_m11_train_and_compare")
def compare(spark, folder):
    """Two models and their weighted ensemble, evaluated on the test split."""
    _, _, metrics = training.compare(frame(spark, folder), two(), m.ENSEMBLE_WEIGHTS)
    return metrics


@query("m11_run_records")
def run_records(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    _, records = m.train({"random_forest": m.random_forest(TREES, DEPTH)}, data.where(F.col("split") == "train"))
    return records


def importance_table(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    model = m.random_forest(TREES, DEPTH).fit(data.where(F.col("split") == "train"))
    return m.importances(model, training.FEATURES, spark)


@query("m12_t03_top_importances")
def top_importances(spark, folder):
    return top_k(importance_table(spark, folder), "importance", 10, "feature")


@query("m12_c07_group_importances")
def group_importances(spark, folder):
    return m.group_importances(importance_table(spark, folder), training.FEATURES)


MEDIAN_SQL = with_panel(
    "lagged AS (SELECT store_id, item_id, date, demand, ln(1 + LAG(demand, 1) OVER (PARTITION BY store_id, item_id ORDER BY date)) AS l1, "
    "MAX(date) OVER () - date AS age FROM panel)",
    "med AS (SELECT quantile_cont(l1, 0.5) AS m1 FROM lagged WHERE age >= 56)",
)


@query(
    "m13_custom_stage",
    MEDIAN_SQL + f"SELECT {cols('store_id', 'item_id', d('date'), f('COALESCE(l1, m1)', 'lag_1_log'), f('0', 'absent'))} FROM lagged CROSS JOIN med",
)
def custom_stage(spark, folder):
    """The preparation stage inside a Spark ML workflow: align, impute, assemble."""
    from pyspark.ml.functions import vector_to_array

    df = frame(spark, folder).select(*training.KEYS, "split", "demand_lag_1_log")
    fitting = df.where(F.col("split") == "train").withColumn("absent", F.lit(0.0))
    fitted = Pipeline(stages=[m.MatrixStage(columns=["demand_lag_1_log", "absent"])]).fit(fitting)
    out = vector_to_array("features")
    return fitted.transform(df).select("store_id", "item_id", "date", out[0].alias("lag_1_log"), out[1].alias("absent"))


@query("m14_promotion")
def promotion(spark, folder):
    models, _, metrics = training.compare(frame(spark, folder), two(3))
    path = shared_path(spark, "promoted")
    training.promote(models, metrics, path)
    return spark.read.json(f"{path}/runs").select("model", "metric", F.col("value").cast("double").alias("value"))


@query("m15_score_all_models")
def score_all(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    models, _ = m.train(two(3), data.where(F.col("split") == "train"))
    return m.score(models, data.where(F.col("split") == "test")).select(*training.KEYS, "demand", *models)


@query("s12_model_save_load")
def save_and_load(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    fitted = Pipeline(stages=[m.random_forest(3, 4)]).fit(data.where(F.col("split") == "train"))
    path = shared_path(spark, "model")
    m.save_model(fitted, path)
    test = data.where(F.col("split") == "test")
    return m.load_model(path).transform(test).select(*training.KEYS, "demand", m.non_negative(F.col("prediction")).alias("y_pred"))


@query("s13_run_table")
def run_table(spark, folder):
    data, _ = training.matrix(frame(spark, folder))
    _, records = m.train({"poisson": m.count_model()}, data.where(F.col("split") == "train"))
    path = shared_path(spark, "runs")
    for row in records.collect():
        append_run(spark, path, row.asDict())
    return spark.read.json(path).select("model", "model_params")
