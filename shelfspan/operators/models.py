"""Forecasting models, ensembles, tuning and promotion on MLlib."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspan.operators.evaluate import basic_metrics
from shelfspan.operators.joins import attach
from shelfspan.operators.prepare import align_columns, assemble, feature_groups, fit_medians
from shelfspan.operators.splits import Fold, fold_rows
from shelfspan.session import settle, shared_folder

LABEL = "demand"
SEED = 42
# Configured ensemble weights.
ENSEMBLE_WEIGHTS = {"lightgbm": 0.4, "xgboost": 0.3, "random_forest": 0.2, "prophet": 0.1}
NORMAL_95 = 1.959963984540054


def non_negative(prediction: Column) -> Column:
    """Demand cannot be negative."""
    return F.greatest(prediction, F.lit(0.0))


def weighted_mean(models: Sequence[str], weights: dict[str, float] | None = None) -> Column:
    """Weighted mean of prediction columns; weights are normalised over the models present."""
    weights = weights or {m: 1.0 for m in models}
    total = sum(weights[m] for m in models)
    return sum((F.col(m) * weights[m] for m in models), F.lit(0.0)) / total


def boosted_trees(trees: int = 500, depth: int = 6, rate: float = 0.05, rows: float = 0.8, columns: float = 0.9,
                  min_rows: int = 5, validation: str | None = None, label: str = LABEL, seed: int = SEED) -> GBTRegressor:
    """Squared-loss boosting; a validation flag column turns on early stopping."""
    model = GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        featureSubsetStrategy=str(columns), minInstancesPerNode=min_rows, seed=seed,
    )
    return model.setValidationIndicatorCol(validation) if validation else model


def count_model(family: str = "poisson", power: float = 1.1, regularisation: float = 0.1, label: str = LABEL) -> GeneralizedLinearRegression:
    """Log-linear model for counts: Poisson, or Tweedie with a variance power."""
    if family == "tweedie":
        return GeneralizedLinearRegression(
            labelCol=label, featuresCol="features", family="tweedie", variancePower=power, linkPower=0.0, regParam=regularisation
        )
    return GeneralizedLinearRegression(labelCol=label, featuresCol="features", family=family, link="log", regParam=regularisation)


def random_forest(trees: int = 200, depth: int = 15, min_rows: int = 2, label: str = LABEL, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows,
        featureSubsetStrategy="sqrt", seed=seed,
    )


# ---- trend and seasonality ------------------------------------------------


#: Share of the history that may hold changes of the trend, and how strongly they are drawn to 0.
CHANGE_RANGE, CHANGE_PENALTY = 0.8, 0.05


def seasonal_basis(
    date: str, start: Column, weekly: int = 3, yearly: int = 10, end: Column | None = None, changepoints: int = 0, events: Sequence[Column] = (),
) -> Column:
    """Constant, trend and Fourier terms of a date as one array, then bends of the trend and events.

    ``changepoints`` bends lie evenly over the first part of the days from
    ``start`` to ``end``; a bend is the time since it, 0 before. Events are
    expressions of the date.
    """
    day = F.datediff(F.col(date), start).cast("double")
    terms = [F.lit(1.0), day / 365.25]
    for period, order in ((7.0, weekly), (365.25, yearly)):
        for k in range(1, order + 1):
            angle = 2 * F.pi() * k * day / period
            terms += [F.sin(angle), F.cos(angle)]
    if changepoints:
        length = F.datediff(end, start).cast("double")
        terms += [F.greatest(day - length * (CHANGE_RANGE * k / (changepoints + 1)), F.lit(0.0)) / 365.25 for k in range(1, changepoints + 1)]
    return F.array(*terms, *[e.cast("double") for e in events])


def _solver(penalties: Sequence[float]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Weighted least squares over one group's days; a penalty is added to the square of its coefficient."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack(frame["basis"].to_numpy())
        n, s, q = (frame[c].to_numpy(dtype=float) for c in ("n", "s", "q"))
        root = np.sqrt(n)
        left, right = x * root[:, None], s / n * root
        if any(penalties):
            drawn = np.sqrt(np.asarray(penalties) * n.sum())
            left, right = np.vstack([left, np.diag(drawn)[drawn > 0]]), np.append(right, np.zeros((drawn > 0).sum()))
        coefficients, *_ = np.linalg.lstsq(left, right, rcond=None)
        fit = x @ coefficients
        squared = np.maximum(q - 2 * fit * s + n * fit * fit, 0).sum()
        spread = float(np.sqrt(squared / max(n.sum() - len(coefficients), 1)))
        return pd.DataFrame({"group": [frame["group"].iloc[0]], "coefficients": [coefficients.tolist()], "spread": [spread]})

    return solve


def fit_seasonal(
    df: DataFrame, by: str, start: Column, label: str = LABEL, date: str = "date", basis: Column | None = None, penalties: Sequence[float] = (), logarithm: bool = True,
) -> DataFrame:
    """Coefficients of log demand per group, or of demand itself.

    Rows are summed per group and day first: the terms depend on the date only,
    so a group's problem has one row per calendar day however many rows it has.
    """
    y = F.col(label).cast("double")
    y = F.log1p(y) if logarithm else y
    terms = seasonal_basis(date, start) if basis is None else basis
    days = df.groupBy(F.col(by).cast("string").alias("group"), date).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")
    )
    rows = days.select("group", "n", "s", "q", terms.alias("basis"))
    return rows.groupBy("group").applyInPandas(_solver(penalties), "group string, coefficients array<double>, spread double")


def bend_penalties(weekly: int = 3, yearly: int = 10, changepoints: int = 25, events: int = 0, strength: float = CHANGE_PENALTY) -> list[float]:
    """Penalties for ``seasonal_basis``: bends are drawn to 0, all else is free."""
    return [0.0] * (2 + 2 * (weekly + yearly)) + [strength] * changepoints + [0.0] * events


def predict_seasonal(df: DataFrame, fitted: DataFrame, by: str, start: Column, date: str = "date", basis: Column | None = None) -> DataFrame:
    """Add ``y_pred`` and its 95 % interval, on the demand scale and not negative."""
    keyed = df.withColumns({"group": F.col(by).cast("string"), "_basis": seasonal_basis(date, start) if basis is None else basis})
    joined = attach(keyed, fitted, ["group"], spread_by=[date])
    level = F.aggregate(F.zip_with("_basis", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    joined = joined.withColumn("_level", level)
    reach = NORMAL_95 * F.col("spread")
    return joined.withColumns(
        {
            "y_pred": non_negative(F.expm1("_level")),
            "y_low": non_negative(F.expm1(F.col("_level") - reach)),
            "y_high": non_negative(F.expm1(F.col("_level") + reach)),
        }
    ).drop("group", "_basis", "_level", "coefficients", "spread")


# ---- training, scoring, tuning --------------------------------------------


def train(estimators: dict[str, Estimator], df: DataFrame, valid: DataFrame | None = None) -> tuple[dict[str, Model], DataFrame]:
    """Fit every estimator; returns the models and a table of run records.

    A record holds the time, the parameters, the error on the training and, if
    given, the validation rows, and the number of features and of trees kept.
    """
    spark = df.sparkSession
    shared_folder(spark)
    models, records = {}, []
    for name, estimator in estimators.items():
        began = time.time()
        models[name] = estimator.fit(df)
        settings = ", ".join(sorted(f"{p.name}={v}" for p, v in estimator.extractParamMap().items()))
        took = float(time.time() - began)
        label = estimator.getOrDefault("labelCol") if estimator.hasParam("labelCol") else LABEL
        errors = [rmse_of(models[name], rows, label) if rows is not None else None for rows in (df, valid)]
        facts = [getattr(models[name], x, None) for x in ("numFeatures", "getNumTrees")]
        records.append((name, took, settings, *errors, *facts))
    return models, spark.createDataFrame(
        records, "model string, training_time double, model_params string, train_rmse double, valid_rmse double, n_features int, trees int"
    )


def score(models: dict[str, Model], df: DataFrame) -> DataFrame:
    """One non-negative prediction column per model on the same rows."""
    for name, model in models.items():
        raw = f"_{name}"
        scored = model.copy({model.getParam("predictionCol"): raw}).transform(df)
        df = scored.withColumn(name, non_negative(F.col(raw))).drop(raw)
    return df


def forecast_frame(scored: DataFrame, models: Sequence[str], keys: Sequence[str], label: str = LABEL) -> DataFrame:
    """Prediction columns as rows ``(keys, model, y_true, y_pred)``."""
    base = scored.select(*keys, F.col(label).cast("double").alias("y_true"), *models)
    return base.unpivot([*keys, "y_true"], list(models), "model", "y_pred")


def importances(model: Model, columns: Sequence[str], spark: SparkSession) -> DataFrame:
    """Feature importances as a table; one row per feature."""
    values = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(columns, values)), "feature string, importance double")


def group_importances(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Importance summed over the feature groups."""
    member = F.array(
        *[F.when(F.col("feature").isin(names), F.lit(group)) for group, names in feature_groups(columns).items() if names]
    )
    named = table.withColumn("feature_group", F.explode(F.array_compact(member)))
    return named.groupBy("feature_group").agg(F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("features"))


def rmse_of(model: Model, df: DataFrame, label: str = LABEL) -> float:
    scored = model.transform(df).select(
        F.col(label).cast("double").alias("y_true"), non_negative(F.col("prediction")).alias("y_pred")
    )
    return scored.agg(basic_metrics()["rmse"]).first()[0]


def grid(space: dict[str, Sequence]) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(space, values)) for values in itertools.product(*space.values())]


def sampled(space: dict[str, tuple], trials: int, seed: int = SEED) -> list[dict]:
    """Random candidates: ``(low, high)`` of ints or floats, or ``(low, high, "log")``."""
    draw = random.Random(seed)

    def pick(spec):
        low, high = spec[:2]
        if len(spec) == 3:
            return float(np.exp(draw.uniform(np.log(low), np.log(high))))
        if isinstance(low, int) and isinstance(high, int):
            return draw.randint(low, high)
        return draw.uniform(low, high)

    return [{name: pick(spec) for name, spec in space.items()} for _ in range(trials)]


def search(make: Callable[..., Estimator], candidates: Sequence[dict], folds: DataFrame, n_splits: int) -> DataFrame:
    """Cross-validated RMSE of every candidate as ``(candidate, params, rmse)``.

    ``folds`` carries ``fold`` and ``role``; it is stored once, and every fit
    pushes its fold and role down to the scan.
    """
    spark = folds.sparkSession
    folds = settle(folds, "folds")
    rows = []
    for number, params in enumerate(candidates):
        errors = []
        for fold in range(n_splits):
            part = folds.where(F.col("fold") == fold)
            fitted = make(**params).fit(part.where(F.col("role") == "train"))
            errors.append(rmse_of(fitted, part.where(F.col("role") == "valid")))
        text = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
        rows.append((number, text, float(np.mean(errors))))
    return spark.createDataFrame(rows, "candidate int, params string, rmse double")


def search_months(
    make: Callable[..., Estimator], space: dict[str, tuple], stored: DataFrame, folds: Sequence[Fold], trials: int = 100, startup: int = 10,
    good: float = 0.25, seed: int = SEED,
) -> DataFrame:
    """Trials that learn from those before: ``candidate, params, source, folds, rmse, pruned``.

    The first ``startup`` candidates are random. Behind them the finished
    trials are parted into the best ``good`` share and the rest; of a number of
    draws from the density of the good ones that is tried whose ratio of good
    to bad density is greatest. A trial ends after a fold whose error exceeds
    the median that earlier trials had there; its rmse is the mean so far.
    ``stored`` comes from ``store_by_month``, so a fold reads only its months.
    """
    draw = random.Random(seed)
    done: list[tuple[dict, float, list[float], bool]] = []
    rows = []
    for number in range(trials):
        finished = [(p, e) for p, e, _, pruned in done if not pruned]
        from_model = number >= startup and len(finished) >= 2
        params = _likely(space, finished, good, draw) if from_model else sampled(space, 1, draw.randrange(1 << 30))[0]
        errors: list[float] = []
        pruned = False
        for fold in folds:
            fitted = make(**params).fit(fold_rows(stored, fold, "train"))
            errors.append(rmse_of(fitted, fold_rows(stored, fold, "valid")))
            earlier = [e[len(errors) - 1] for _, _, e, _ in done if len(e) >= len(errors)]
            if number >= startup and len(errors) < len(folds) and earlier and errors[-1] > float(np.median(earlier)):
                pruned = True
                break
        done.append((params, float(np.mean(errors)), errors, pruned))
        text = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
        rows.append((number, text, "model" if from_model else "random", len(errors), float(np.mean(errors)), pruned))
    return stored.sparkSession.createDataFrame(rows, "candidate int, params string, source string, folds int, rmse double, pruned boolean")


def _likely(space: dict[str, tuple], finished: Sequence[tuple[dict, float]], good: float, draw: random.Random, draws: int = 24) -> dict:
    """The draw from the good trials' densities with the greatest ratio to the others', parameter by parameter."""
    ranked = [p for p, _ in sorted(finished, key=lambda t: t[1])]
    cut = max(1, int(np.ceil(good * len(ranked))))
    chosen = {}
    for name, (low, high, *scale) in space.items():
        to, back = (np.log, np.exp) if scale else (float, float)
        a, b = to(low), to(high)
        width = max(b - a, 1e-12)
        best, rest = ([to(p[name]) for p in part] or [(a + b) / 2] for part in (ranked[:cut], ranked[cut:]))
        spread = width / max(2.0, np.sqrt(len(ranked)))

        def density(x: float, around: Sequence[float]) -> float:
            # A share of the uniform density keeps every value possible.
            return 0.1 / width + 0.9 * float(np.mean([np.exp(-((x - c) ** 2) / (2 * spread**2)) for c in around])) / spread  # noqa: B023

        tried = [min(max(draw.gauss(draw.choice(best), spread), a), b) for _ in range(draws)]
        value = float(back(max(tried, key=lambda x: density(x, best) / density(x, rest))))  # noqa: B023
        value = min(max(value, low), high)
        chosen[name] = round(value) if isinstance(low, int) and isinstance(high, int) and not scale else value
    return chosen


def best_candidate(results: DataFrame) -> DataFrame:
    return results.agg(F.min_by("candidate", "rmse").alias("candidate"), F.min_by("params", "rmse").alias("params"), F.min("rmse").alias("rmse"))


# ---- a persistable preparation stage ---------------------------------------


class _MatrixParams(Params):
    columns = Param(Params._dummy(), "columns", "feature columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "fitted medians", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)


class MatrixStage(Estimator, _MatrixParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the feature columns and their medians from training rows."""

    @keyword_only
    def __init__(self, *, columns=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features", medians=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MatrixModel:
        names = self.getOrDefault(self.columns)
        known = {r["column"]: r["median"] for r in fit_medians(dataset, names).collect()}
        model = MatrixModel()
        model._set(columns=names, medians=[float(known.get(c) or 0.0) for c in names], outputCol=self.getOrDefault(self.outputCol))
        return model


class MatrixModel(Model, _MatrixParams, DefaultParamsReadable, DefaultParamsWritable):
    """Aligns to the fitted columns, fills with medians and assembles a vector."""

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="features", medians=[])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.columns)
        keep = [c for c in dataset.columns if c not in names]
        aligned = align_columns(dataset, names, keep=keep)
        fitted = dict(zip(names, self.getOrDefault(self.medians)))
        filled = aligned.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fitted[c])) for c in names})
        return assemble(filled, names, self.getOrDefault(self.outputCol))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
