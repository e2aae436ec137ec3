"""Global order helpers, joins and encodings."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfspan.operators import encode, joins, ordering, prepare, profile, splits


def test_exact_percentiles_by_group(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if n % 3 else "b", float(v)) for n, v in enumerate(rng.integers(0, 40, 500))]
    df = spark.createDataFrame(rows, "g string, x double")
    out = {(r.g, r.p): r.value for r in ordering.exact_percentiles(df, ["x"], [0, 0.05, 0.5, 0.9, 1], ["g"]).collect()}
    for g in "ab":
        values = [v for k, v in rows if k == g]
        for p in (0, 0.05, 0.5, 0.9, 1):
            assert abs(out[(g, p)] - np.quantile(values, p)) < 1e-9


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_median_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = prepare.fit_medians(df, ["x"]).first()["median"]
    assert abs(got - np.median(values)) < 1e-9


def test_running_totals(spark):
    df = spark.createDataFrame([(n, n % 4) for n in range(200)], "k int, w int")
    out = {r.k: r.w_before for r in ordering.running_totals(df, ["k"], ["w"]).collect()}
    total = 0
    for n in range(200):
        assert out[n] == total
        total += n % 4


def test_codes_are_alphabetical_per_column(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x"), ("Z", None)], "u string, v string")
    codes = encode.fit_codes(encode.category_values(df, ["u", "v"], "None"))
    out = {(r["column"], r.value): r.code for r in codes.collect()}
    assert [out[("u", v)] for v in ("Z", "a", "b", "c")] == [0, 1, 2, 3]
    assert [out[("v", v)] for v in ("None", "x", "y")] == [0, 1, 2]


def test_unknown_values_share_one_code(spark):
    known = spark.createDataFrame([("a",), ("b",)], "u string")
    new = spark.createDataFrame([("a",), ("q",), ("r",), (None,)], "u string")
    codes = encode.fit_codes(encode.category_values(known, ["u"]))
    out = {r.u: r.u_encoded for r in encode.apply_codes_or_unknown(new, codes, ["u"]).collect()}
    assert out == {"a": 0, "q": 2, "r": 2, None: 2}


def test_unknown_uses_fitted_class_of_that_name(spark):
    known = spark.createDataFrame([("a",), ("unknown",), ("z",)], "u string")
    codes = encode.fit_codes(encode.category_values(known, ["u"]))
    out = encode.apply_codes_or_unknown(spark.createDataFrame([("q",)], "u string"), codes, ["u"]).first()
    assert out.u_encoded == 1


def test_salted_join_equals_broadcast_join(spark):
    """A key with a third of the rows, joined both ways."""
    facts = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    lookup = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small = joins.attach(facts, lookup, ["k"], spread_by=["id"])
    salted = joins.attach(facts, lookup, ["k"], spread_by=["id"], limit=0, salts=8)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(salted.select(*small.columns).collect())
    assert salted.count() == 900


def test_target_encoding_matches_group_statistics(small_panel, small_pandas):
    out = encode.add_target_encoding(small_panel, ["item_id", "store_id"]).toPandas().drop_duplicates("item_id").set_index("item_id")
    stats = small_pandas.groupby("item_id")["demand"].agg(["mean", "std", "count"])
    np.testing.assert_allclose(out.loc[stats.index, "item_id_target_mean"], stats["mean"])
    np.testing.assert_allclose(out.loc[stats.index, "item_id_target_std"], stats["std"])
    assert (out.loc[stats.index, "item_id_target_count"] == stats["count"]).all()


def test_target_encoding_of_large_values(spark):
    rows = [("a" if n % 2 else "b", n % 3, 1e8 + n % 10) for n in range(1000)]
    df = spark.createDataFrame(rows, "k string, g int, date_ double").withColumnRenamed("date_", "y").withColumn("date", F.lit(1))
    got = {r.k: r.k_target_std for r in encode.add_target_encoding(df, ["k", "g"], "y").select("k", "k_target_std").distinct().collect()}
    for k in "ab":
        assert got[k] == pytest.approx(np.std([r[2] for r in rows if r[0] == k], ddof=1), rel=1e-6)


def test_models_aligned_on_keys(spark):
    rows = [("k1", "a", 1.0), ("k1", "b", 2.0), ("k2", "a", 3.0), ("k3", "a", None), ("k3", "b", 4.0), (None, "a", 1.0), (None, "b", 1.0)]
    df = spark.createDataFrame(rows, "k string, model string, y_pred double")
    out = joins.align_forecasts({m: df.where(F.col("model") == m) for m in "ab"}, ["k"])
    assert sorted(map(tuple, out.collect())) == [("k1", 1.0, 2.0), ("k3", None, 4.0)]


def test_target_encoding_fitted_on_other_rows(small_panel):
    fitted = small_panel.where(F.col("day_num") <= 10)
    out = encode.add_target_encoding(small_panel, ["item_id"], fit_on=fitted).select("item_id_target_count").distinct().collect()
    assert [r[0] for r in out] == [20]


def test_split_is_complete_and_disjoint(small_panel):
    out = splits.split_by_last_days(small_panel, 28, 28).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"train": 34 * 4, "valid": 28 * 4, "test": 28 * 4}
    other = splits.split_by_distinct_dates(small_panel, 28, 28).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in other} == {"train": 34 * 4, "valid": 28 * 4, "test": 28 * 4}


def test_folds_train_before_valid(small_panel):
    for make in (splits.rolling_origin_folds, splits.expanding_folds):
        rows = make(small_panel, 3, *((14, 14) if make is splits.rolling_origin_folds else ())).groupBy("fold", "role").agg(
            F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
        found = {(r.fold, r.role): r for r in rows}
        for fold in range(3):
            assert found[(fold, "train")].hi < found[(fold, "valid")].lo


def test_sample_is_seeded(small_panel):
    first = ordering.sample_rows(small_panel.select("id", "d"), 20, 5)
    assert first.count() == 20
    assert sorted(first.collect()) == sorted(ordering.sample_rows(small_panel.select("id", "d"), 20, 5).collect())


def test_first_items(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 1), ("a", 1)], "item_id string, date int")
    assert [r.item_id for r in ordering.first_items(df, 2).orderBy("item_id").collect()] == ["a", "b"]


def test_histogram_keeps_all_rows(small_panel):
    out = profile.histogram(small_panel, "demand", 5, ["store_id"], density=True).groupBy("store_id").agg(F.sum("n").alias("n")).collect()
    assert {r.n for r in out} == {180}


def test_numeric_matrix_and_imputation(spark):
    df = spark.createDataFrame([("1", "x", None, True), ("2.5", "y", 4.0, False), (None, "x", float("inf"), True)],
                               "t string, c string, v double, b boolean")
    matrix = prepare.numeric_matrix(df, ["t", "c", "v", "b"])
    filled = prepare.impute(matrix, ["t", "c", "v", "b"], prepare.fit_medians(matrix, ["t", "c", "v", "b"]))
    assert sorted(map(tuple, filled.collect())) == [(1.0, 0.0, 4.0, 1.0), (1.75, 0.0, 4.0, 1.0), (2.5, 1.0, 4.0, 0.0)]


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, extra int")
    assert prepare.align_columns(df, ["missing", "a"]).columns == ["missing", "a"]


def test_robust_scaling(spark):
    from pyspark.ml.functions import vector_to_array

    df = prepare.assemble(spark.createDataFrame([(float(n),) for n in range(101)], "x double"), ["x"])
    out = prepare.robust_scaler().fit(df).transform(df).select(vector_to_array("scaled")[0].alias("s")).toPandas()["s"]
    np.testing.assert_allclose(sorted(out), [(n - 50) / 50 for n in range(101)], atol=0.05)
