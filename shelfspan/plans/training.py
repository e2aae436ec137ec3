"""Training frame, model comparison and promotion."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import cyclic, date_parts, weekend
from shelfspan.operators import evaluate as ev
from shelfspan.operators.demand import add_activity, add_lags, add_rolling
from shelfspan.operators.models import MatrixStage, forecast_frame, save_model, score, train, weighted_mean
from shelfspan.operators.splits import split_by_last_days
from shelfspan.plans.chain import DemandChain
from shelfspan.session import settle, shared_folder
from shelfspan.sources.tables import append_run

KEYS = ("store_id", "item_id", "cat_id", "date")
LAGS = (1, 7, 14, 28)
WINDOWS = (7, 28)
FEATURES = (
    *[f"demand_lag_{n}_log" for n in LAGS],
    *[f"demand_rolling_{s}_{n}" for n in WINDOWS for s in ("mean", "max")],
    *[f"active_days_last_{n}" for n in (7, 28)],
    "is_weekend", "dayofweek_sin", "dayofweek_cos", "month_sin", "month_cos",
)


def training_frame(panel: DataFrame) -> DataFrame:
    """Leak-free lag, rolling and calendar features with a split column."""
    df = add_activity(panel.select(*KEYS, "demand"), (7, 28), shift=1)
    df = add_rolling(add_lags(df, LAGS), WINDOWS, stats=("mean", "max"), shift=1)
    df = df.withColumns({**date_parts(), "is_weekend": weekend()})
    waves = {}
    # Periods of the cyclic encodings.
    for name, period in (("dayofweek", 7), ("month", 12)):
        waves[f"{name}_sin"], waves[f"{name}_cos"] = cyclic(F.col(name), period)
    return split_by_last_days(df.withColumns(waves)).select(*KEYS, "demand", "split", *FEATURES)


def matrix(frame: DataFrame, columns: Sequence[str] = FEATURES) -> tuple[DataFrame, PipelineModel]:
    """Stored model matrix, and the stage fitted on the training rows."""
    stage = Pipeline(stages=[MatrixStage(columns=list(columns))]).fit(frame.where(F.col("split") == "train"))
    return settle(stage.transform(frame).select(*KEYS, "demand", "split", "features"), "matrix"), stage


def compare(
    frame: DataFrame, estimators: dict[str, Estimator], weights: dict[str, float] | None = None, columns: Sequence[str] = FEATURES
) -> tuple[dict, DataFrame, DataFrame]:
    """Train, score the test split with every model and their ensemble, evaluate.

    Returns the fitted pipelines, which take rows of the frame, the run records
    and the metric table.
    """
    shared_folder(frame.sparkSession)
    data, stage = matrix(frame, columns)
    models, records = train(estimators, data.where(F.col("split") == "train"), data.where(F.col("split") == "valid"))
    scored = score(models, data.where(F.col("split") == "test"))
    names = list(models)
    scored = scored.withColumn("ensemble", weighted_mean(names, weights))
    forecasts = forecast_frame(scored, [*names, "ensemble"], KEYS)
    pipelines = {name: PipelineModel(stages=[*stage.stages, model]) for name, model in models.items()}
    return pipelines, records, ev.simple_record(settle(forecasts, "forecasts"))


class Path(NamedTuple):
    """What the training path makes: pipelines that take rows of its input, records, forecasts and their metrics."""

    pipelines: dict[str, PipelineModel]
    records: DataFrame
    forecasts: DataFrame
    metrics: DataFrame
    by_category: DataFrame
    columns: list[str]


def fit_path(df: DataFrame, estimators: dict[str, Estimator], weights: dict[str, float] | None = None) -> Path:
    """Fit the leak-free chain and every model on the training rows, score and evaluate the test rows.

    ``df`` is an integrated panel with ``split``. The chain, the medians and the
    models learn from its training rows only; the features of later rows come
    from the stored chain. Each pipeline is the chain, the matrix stage and the
    model, so it scores raw rows that bring their history along.
    """
    shared_folder(df.sparkSession)
    fitted = DemandChain().fit(df.where(F.col("split") == "train"))
    columns = fitted.getOrDefault(fitted.columns)
    featured = settle(fitted.transform(df), "featured")
    stage = MatrixStage(columns=columns).fit(featured.where(F.col("split") == "train"))
    data = settle(stage.transform(featured).select(*KEYS, "demand", "split", "features"), "matrix")
    models, records = train(estimators, data.where(F.col("split") == "train"), data.where(F.col("split") == "valid"))
    scored = score(models, data.where(F.col("split") == "test")).withColumn("ensemble", weighted_mean(list(models), weights))
    forecasts = settle(forecast_frame(scored, [*models, "ensemble"], KEYS), "forecasts")
    pipelines = {name: PipelineModel(stages=[fitted, stage, model]) for name, model in models.items()}
    return Path(pipelines, records, forecasts, ev.simple_record(forecasts), ev.simple_record(forecasts, ("model", "cat_id")), columns)


def promote(models: dict[str, PipelineModel], metrics: DataFrame, folder: str, metric: str = "rmse") -> str:
    """Save the best pipeline below ``folder`` and append its record.

    Only the given pipelines compete: an ensemble in ``metrics`` has no single
    one to save, and the record names the candidates.
    """
    largest = metric == "r2"
    names = list(models)
    best = ev.best_model(metrics.where(F.col("model").isin(names)), metric, largest).first()
    save_model(models[best["model"]], f"{folder}/model")
    append_run(
        metrics.sparkSession, f"{folder}/runs",
        {"model": best["model"], "metric": metric, "value": best[metric], "candidates": ",".join(names), "features": ",".join(FEATURES)},
    )
    return best["model"]
