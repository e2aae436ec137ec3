"""Window features against pandas on a small panel, and plan shape."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspan.operators import demand, panel, price

K = ["store_id", "item_id"]


def ordered(df):
    return df.toPandas().sort_values([*K, "date"]).reset_index(drop=True)


def same(left, right):
    np.testing.assert_allclose(np.asarray(left, dtype=float), np.asarray(right, dtype=float), rtol=1e-9, atol=1e-9)


def test_lags_and_flags(small_panel, small_pandas):
    out = ordered(demand.add_lags(small_panel, [1, 7]))
    expected = small_pandas.groupby(K)["demand"].shift(7)
    same(out["demand_lag_7"], expected)
    same(out["demand_lag_7_log"], np.log1p(expected))
    assert (out["demand_lag_7_nonzero"] == (expected > 0).astype(int)).all()


@pytest.mark.parametrize("stat", ["mean", "std", "max", "min"])
def test_rolling(small_panel, small_pandas, stat):
    out = ordered(demand.add_rolling(small_panel, [7, 28], stats=[stat]))
    for n in (7, 28):
        rolled = small_pandas.groupby(K)["demand"].rolling(n, min_periods=1)
        same(out[f"demand_rolling_{stat}_{n}"], getattr(rolled, stat)().reset_index(drop=True))


def test_shift_leaves_current_day_out(small_panel, small_pandas):
    out = ordered(demand.add_rolling(small_panel, [7], stats=["mean"], shift=1))
    shifted = small_pandas.groupby(K)["demand"].shift(1)
    expected = shifted.groupby([small_pandas[c] for c in K]).rolling(7, min_periods=1).mean().reset_index(drop=True)
    same(out["demand_rolling_mean_7"], expected)


def test_adjusted_ewm(small_panel, small_pandas):
    out = ordered(demand.add_ewm(small_panel))
    for a in (0.1, 0.3, 0.5):
        expected = small_pandas.groupby(K)["demand"].ewm(alpha=a).mean().reset_index(drop=True)
        same(out[f"demand_ewm_{str(a).replace('.', '_')}"], expected)


def test_recursive_ewm(small_panel, small_pandas):
    out = ordered(demand.add_recursive_ewm(small_panel))
    for n in (7, 14, 28, 56):
        expected = small_pandas.groupby(K)["demand"].ewm(span=n, adjust=False).mean().reset_index(drop=True)
        same(out[f"demand_ewm_{n}"], expected)


def test_ewm_of_distant_decays(small_panel, small_pandas):
    out = demand.add_ewm(small_panel, [0.01, 0.9, 1.0]).toPandas().sort_values(["store_id", "item_id", "date"]).reset_index(drop=True)
    by = small_pandas.groupby(["store_id", "item_id"])["demand"]
    for a in (0.01, 0.9, 1.0):
        want = by.transform(lambda s, a=a: s.ewm(alpha=a).mean())
        np.testing.assert_allclose(out[f"demand_ewm_{str(a).replace('.', '_')}"], want, atol=1e-9)
    out = demand.add_recursive_ewm(small_panel, [1, 500]).toPandas().sort_values(["store_id", "item_id", "date"]).reset_index(drop=True)
    for n in (1, 500):
        want = by.transform(lambda s, n=n: s.ewm(span=n, adjust=False).mean())
        np.testing.assert_allclose(out[f"demand_ewm_{n}"], want, atol=1e-9)


def test_ewm_over_many_blocks(spark):
    """A series of several blocks, so that sums are carried over block borders."""
    rng = np.random.default_rng(3)
    values = rng.integers(0, 30, 3000)
    frame = pd.DataFrame({"store_id": "S", "item_id": "I", "date": pd.date_range("2000-01-01", periods=3000).date, "demand": values})
    df = spark.createDataFrame(frame)
    out = ordered(demand.add_ewm(df, [0.5]))
    same(out["demand_ewm_0_5"], frame["demand"].ewm(alpha=0.5).mean())
    out = ordered(demand.add_recursive_ewm(df, [14, 56]))
    same(out["demand_ewm_56"], frame["demand"].ewm(span=56, adjust=False).mean())


def test_days_since_last_sale(small_panel, small_pandas):
    out = ordered(demand.add_days_since_sale(small_panel))
    expected = []
    for _, group in small_pandas.groupby(K, sort=False):
        sold = group[group["demand"] > 0]["date"]
        for day in group["date"]:
            earlier = [s for s in sold if s < day]
            expected.append((day - max(earlier)).days if earlier else 999)
    assert out["days_since_last_sale"].tolist() == expected


def test_intermittency(small_panel, small_pandas):
    out = ordered(demand.add_intermittency(small_panel, [14]))
    rolled = small_pandas.groupby(K)["demand"].rolling(14, min_periods=1)
    same(out["intermittency_ratio_14"], rolled.apply(lambda x: (x == 0).mean()).reset_index(drop=True))
    same(out["demand_intensity_14"], rolled.apply(lambda x: x[x > 0].mean() if (x > 0).any() else 0).reset_index(drop=True))


def test_price_fill_and_change(small_panel, small_pandas):
    filled = price.fill_prices(small_panel)
    out = ordered(price.add_price_windows(filled, [7]))
    expected = small_pandas.groupby(K)["sell_price"].ffill()
    expected = expected.groupby([small_pandas[c] for c in K]).bfill()
    same(out["sell_price"], expected)
    by = expected.groupby([small_pandas[c] for c in K])
    same(out["price_change"], by.diff())
    same(out["price_change_pct"], by.pct_change(fill_method=None))
    same(out["price_momentum_7"], by.rolling(7).mean().reset_index(drop=True))


def test_relative_change_pads_nulls(spark):
    df = spark.createDataFrame([("S", "I", 1, 2.0), ("S", "I", 2, None), ("S", "I", 3, 3.0), ("S", "I", 4, 0.0), ("S", "I", 5, 1.0)],
                               "store_id string, item_id string, date int, p double")
    out = price.add_relative_change(df, "c", "p").orderBy("date").toPandas()["c"].tolist()
    assert out[1] == 0 and out[2] == 0.5 and out[3] == -1 and np.isnan(out[0]) and np.isnan(out[4])


def test_full_frame_mean_needs_all_values(spark):
    df = spark.createDataFrame([("S", "I", n, float(n)) for n in range(5)], "store_id string, item_id string, date int, p double")
    out = df.withColumn("m", price.full_frame_mean("p", 3)).orderBy("date").toPandas()["m"]
    assert out.isna().tolist() == [True, True, False, False, False] and out[4] == 3.0


def test_naive_restarts_per_series(small_panel):
    out = ordered(small_panel.withColumn("n", demand.naive_forecast()))
    assert (out.groupby(K)["n"].first() == 0).all()


def test_densify_keeps_totals_and_fills_days(spark):
    df = spark.createDataFrame([("S", "I", "2020-01-01", 2), ("S", "I", "2020-01-01", 3), ("S", "I", "2020-01-04", 1)],
                               "store_id string, item_id string, date string, demand int").withColumn("date", F.to_date("date"))
    low, high = df.agg(F.min("date")).scalar(), df.agg(F.max("date")).scalar()
    out = panel.densify(df, low, high).orderBy("date").toPandas()["demand"].tolist()
    assert out == [5, 0, 0, 1]


def test_one_exchange_for_all_series_windows(spark, small_panel):
    df = small_panel.select(*K, "date", "demand", "sell_price")
    chain = demand.add_ewm(demand.add_intermittency(demand.add_rolling(demand.add_activity(demand.add_lags(df)))))
    chain = price.add_price_windows(demand.add_days_since_sale(chain))
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "SinglePartition" not in plan


def test_densify_keeps_fractions(spark):
    import datetime as dt

    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("S", "I", day, 0.6), ("S", "I", day, 0.6)], "store_id string, item_id string, date date, demand double")
    low = high = F.lit(day)
    assert panel.densify(df, low, high).first()["demand"] == 1.2
    assert panel.densify(df, low, high, whole=True).first()["demand"] == 1
