"""Gap expansion, blocks, earlier-day statistics, folds by month, sums of trees and trend bends on small tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfspan.operators import blocks, boosting, encode, models, panel, prepare, splits
from shelfspan.operators.demand import add_days_since_sale, add_lags, add_rolling
from shelfspan.session import discard, settle

DAY = dt.date(2020, 1, 1)


def day(n: int) -> dt.date:
    return DAY + dt.timedelta(days=n)


def test_gap_expansion_keeps_every_series(spark):
    """Days before the first sale, gaps, days outside the bounds and null days; one exchange on the series."""
    rows = [("a", "x", day(2), 3), ("a", "x", day(2), 4), ("a", "x", day(5), 1), ("a", "x", None, 9), ("b", "x", day(40), 5), ("c", "x", None, 1), ("d", "x", day(0), None)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, demand long")
    out = panel.densify(df, F.lit(day(0)), F.lit(day(6)))
    got = {}
    for r in out.orderBy("store_id", "date").collect():
        got.setdefault(r["store_id"], []).append((r["date"], r["demand"]))
    assert {k: [n for _, n in v] for k, v in got.items()} == {"a": [0, 0, 7, 0, 0, 1, 0], "b": [0] * 7, "c": [0] * 7, "d": [0] * 7}
    assert all([d for d, _ in v] == [day(n) for n in range(7)] for v in got.values())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


@pytest.mark.parametrize("days", [1, 10, 400])
def test_blocks_equal_plain_windows(spark, small_panel, days):
    compute = lambda df, keys: add_rolling(add_lags(df, (1, 28), keys, detail=False), (7, 14), keys)
    base = small_panel.select("store_id", "item_id", "date", "demand")
    plain = compute(base, ("store_id", "item_id"))
    cut = blocks.in_blocks(base, compute, blocks.widest((1, 28), (7, 14)), days)
    assert cut.columns == plain.columns and cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()
    assert "hashpartitioning(store_id" in (text := cut._jdf.queryExecution().executedPlan().toString()) and "_block" in text
    assert blocks.add_last_sale(base, days).exceptAll(add_days_since_sale(base)).isEmpty()


def test_earlier_day_statistics(spark):
    rows = [("a", "x", day(0), 1.0), ("b", "x", day(0), 3.0), ("a", "x", day(1), 100.0), ("a", "y", day(1), 5.0), ("a", None, day(2), 7.0)]
    df = spark.createDataFrame(rows, "store_id string, item_id string, date date, demand double")
    got = {(r["store_id"], r["item_id"], r["date"]): (r["item_id_past_mean"], r["item_id_past_std"], r["item_id_past_count"]) for r in encode.add_past_target_encoding(df, ["item_id"]).collect()}
    assert len(got) == 5 and got["a", "x", day(0)] == got["a", "y", day(1)] == got["a", None, day(2)] == (None, 0.0, 0)
    mean, std, count = got["a", "x", day(1)]
    assert (mean, count) == (2.0, 2) and abs(std - 2**0.5) < 1e-9


def test_folds_read_their_months_only(spark):
    df = spark.createDataFrame([(day(n), n) for n in range(120)], "date date, demand int")
    stored = splits.store_by_month(df)
    folds = splits.expanding_bounds(stored, 3)
    assert [f.valid_from for f in folds] == [day(30), day(60), day(90)]
    rows = splits.fold_rows(stored, folds[0], "valid")
    assert rows.count() == 30 and "PartitionFilters: [isnotnull(month_start" in rows._jdf.queryExecution().executedPlan().toString()


def test_sum_of_trees_equals_mllib(spark):
    random = np.random.default_rng(1)
    df = spark.createDataFrame([(float(a), float(b), float(a * 2 + (b > 0) + random.normal())) for a, b in random.normal(size=(300, 2))], "a double, b double, demand double")
    data = settle(prepare.assemble(df, ["a", "b"]), "data")
    fitted = GBTRegressor(labelCol="demand", maxIter=6, maxDepth=3).fit(data)
    cut = boosting.cut_at_best(fitted, data, data)
    assert cut.getNumTrees == 6  # training error only falls
    both = cut.copy({cut.predictionCol: "own"}).transform(fitted.transform(data))
    assert both.where("abs(own - prediction) > 1e-9").isEmpty()
    discard(data)
    assert boosting.kept_by_patience([3, 2, 2.5, 2.6, 1], 2) == 2 and boosting.kept_by_patience([3, 2, 2.5, 2.6, 1], 9) == 5 and boosting.kept_by_patience([], 3) == 0


def test_trend_finds_a_planted_bend(spark):
    rows = [("g", day(n), 10.0 + (0.0 if n < 200 else 0.05 * (n - 200))) for n in range(400)]
    df = spark.createDataFrame(rows, "cat_id string, date date, demand double")
    start, end = F.lit(day(0)), F.lit(day(399))
    basis = models.seasonal_basis("date", start, weekly=0, yearly=0, end=end, changepoints=7)
    fitted = models.fit_seasonal(df, "cat_id", start, basis=basis, penalties=models.bend_penalties(0, 0, 7, strength=1e-6), logarithm=False)
    bends = fitted.first()["coefficients"][2:]
    # The fifth of seven bends over 0.8 of 399 days lies at day 199.5.
    assert int(np.argmax(np.abs(bends))) == 4 and abs(bends[4] / 365.25 - 0.05) < 0.005
