"""Models on a small panel: fits, identities, persistence."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from shelfspan.operators import models as m
from shelfspan.plans import training


@pytest.fixture(scope="module")
def matrix(spark, small_panel):
    return training.matrix(training.training_frame(small_panel))[0].cache()


def test_seasonal_fit_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    days = pd.date_range("2020-01-01", periods=200)
    frame = pd.DataFrame({"g": ["a"] * 200 + ["b"] * 200 + ["a"] * 200, "date": list(days.date) * 3, "demand": rng.integers(0, 20, 600)})
    df = spark.createDataFrame(frame)
    start = F.to_date(F.lit("2020-01-01"))
    fitted = m.fit_seasonal(df, "g", start)
    got = {r.group: (np.array(r.coefficients), r.spread) for r in fitted.collect()}
    n = np.arange(200.0)
    x = [np.ones(200), n / 365.25]
    for period, order in ((7, 3), (365.25, 10)):
        for k in range(1, order + 1):
            x += [np.sin(2 * np.pi * k * n / period), np.cos(2 * np.pi * k * n / period)]
    for g, copies in (("a", 2), ("b", 1)):
        design = np.tile(np.array(x).T, (copies, 1))
        y = np.log1p(frame[frame.g == g]["demand"].to_numpy(dtype=float))
        fit = design @ np.linalg.lstsq(design, y, rcond=None)[0]
        np.testing.assert_allclose(np.array(x).T @ got[g][0], fit[:200], atol=1e-6)
        assert got[g][1] == pytest.approx(np.sqrt(((y - fit) ** 2).sum() / (len(y) - design.shape[1])), rel=1e-6)
    out = m.predict_seasonal(df, fitted, "g", start)
    assert out.where("y_low <= y_pred and y_pred <= y_high and y_low >= 0").count() == 600


def test_training_beats_a_constant_and_repeats(matrix):
    train = matrix.where("split = 'train'")
    errors = [m.rmse_of(m.boosted_trees(5, 3).fit(train), train) for _ in range(2)]
    constant = train.agg(F.stddev_pop("demand")).first()[0]
    assert errors[0] == errors[1] < constant


def test_scores_are_not_negative_and_weights_normalised(matrix):
    train = matrix.where("split = 'train'")
    models, records = m.train({"xgboost": m.boosted_trees(3, 2), "random_forest": m.random_forest(3, 3)}, train)
    assert records.count() == 2
    assert all(r.train_rmse > 0 and r.valid_rmse is None and r.n_features == len(training.FEATURES) and r.trees == 3 for r in records.collect())
    scored = m.score(models, matrix).withColumn("ensemble", m.weighted_mean(list(models), m.ENSEMBLE_WEIGHTS))
    bad = scored.where("xgboost < 0 or random_forest < 0 or ensemble > greatest(xgboost, random_forest) + 1e-9 or ensemble < least(xgboost, random_forest) - 1e-9")
    assert bad.count() == 0
    table = m.importances(models["random_forest"], training.FEATURES, matrix.sparkSession)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_count_models(matrix):
    train = matrix.where("split = 'train'")
    for family in ("poisson", "tweedie"):
        assert m.rmse_of(m.count_model(family).fit(train), train) < 20


def test_early_stopping_keeps_fewer_trees(matrix):
    data = matrix.withColumn("is_valid", F.col("split") == "valid").where("split <> 'test'")
    fitted = m.boosted_trees(40, 5, rate=0.9, rows=1.0, columns=1.0, validation="is_valid").fit(data)
    assert fitted.getNumTrees < 40


def test_stage_round_trip(spark, small_panel, tmp_path):
    frame = training.training_frame(small_panel)
    fitted = Pipeline(stages=[m.MatrixStage(columns=list(training.FEATURES)), m.random_forest(2, 2)]).fit(frame)
    m.save_model(fitted, str(tmp_path / "model"))
    again = m.load_model(str(tmp_path / "model"))
    assert isinstance(again, PipelineModel)
    pick = lambda model: sorted(r.prediction for r in model.transform(frame.drop("is_weekend")).select("prediction").collect())
    assert pick(again) == pick(fitted)


def test_search_spaces():
    assert len(m.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    drawn = m.sampled({"a": (1, 5), "b": (0.5, 1.0), "c": (0.01, 0.3, "log")}, 20)
    assert drawn == m.sampled({"a": (1, 5), "b": (0.5, 1.0), "c": (0.01, 0.3, "log")}, 20)
    assert all(1 <= c["a"] <= 5 and 0.5 <= c["b"] <= 1 and 0.01 <= c["c"] <= 0.3 for c in drawn)


def test_grid_search_reports_every_candidate(matrix):
    from shelfspan.operators.splits import expanding_folds

    folds = expanding_folds(matrix.select(*training.KEYS, "demand", "features"), 2)
    out = m.search(m.random_forest, m.grid({"trees": [2], "depth": [1, 3]}), folds, 2)
    assert out.count() == 2
    assert m.best_candidate(out).first().rmse == out.agg(F.min("rmse")).first()[0]


def test_promotion(spark, small_panel, tmp_path):
    models, _, metrics = training.compare(training.training_frame(small_panel), {"a": m.random_forest(2, 2), "b": m.random_forest(2, 4)})
    best = training.promote(models, metrics, str(tmp_path))
    run = spark.read.json(str(tmp_path / "runs")).first()
    assert best in models and run.model == best and run.candidates == "a,b"
    raw = training.training_frame(small_panel.where("date >= '2020-03-01'")).drop("split", "demand")
    scored = m.load_model(str(tmp_path / "model")).transform(raw)
    assert scored.where("prediction is not null").count() == raw.count() > 0
