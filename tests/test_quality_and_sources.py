"""Rules on broken tables, and file round trips."""

import json

import pytest
from pyspark.sql import functions as F

from shelfspan.functions import scalar
from shelfspan.operators import external, panel, quality
from shelfspan.plans import etl
from shelfspan.session import settle, shared_path
from shelfspan.sources import tables


def found(df):
    return {(r.dataset, r.rule, r["column"]): r.violations for r in df.collect()}


def test_broken_sales_table(spark):
    wide = spark.createDataFrame([("a", "i", "s", -1, "x"), ("a", "i", "s", 2, "3")], "id string, item_id string, store_id string, d_1 int, d_2 string")
    out = found(etl._together([quality.run_rules(wide, "sales", quality.sales_rules(wide)), quality.duplicate_rule(wide, "sales")]))
    assert out[("sales", "required_column", "cat_id")] == 1 and out[("sales", "required_column", "id")] == 0
    assert out[("sales", "day_columns", "d_*")] == 1
    assert out[("sales", "numeric_type", "d_2")] == 1 and out[("sales", "numeric_type", "d_1")] == 0
    assert out[("sales", "non_negative", "d_1")] == 1 and out[("sales", "unique", "id")] == 1


def test_broken_calendar(spark):
    days = spark.createDataFrame([("2011-01-30",), ("2011-02-01",), ("nonsense",)], "date string")
    out = found(quality.run_rules(days, "calendar", quality.calendar_rules(days)))
    assert out[("calendar", "date_format", "date")] == 1
    assert out[("calendar", "starts_in_time", "date")] == 1 and out[("calendar", "ends_in_time", "date")] == 1
    gaps = panel.date_gaps(days.withColumn("date", F.col("date").try_cast("date")).dropna())
    assert [r.step_days for r in gaps.collect()] == [2]


def test_prices_weather_economic(spark):
    prices = spark.createDataFrame([("s", "i", 1, 0.0), ("s", "i", 2, 2000.0), ("s", "i", 3, None)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    out = found(quality.run_rules(prices, "prices", quality.price_rules(prices)))
    assert [out[("prices", r, "sell_price")] for r in ("positive", "not_extreme", "not_null")] == [1, 1, 1]
    weather = spark.createDataFrame([("2020-01-01", "CA", 200.0, 50.0), ("2020-01-02", "CA", 20.0, -1.0)], "date string, state_id string, temp double, humidity double")
    economic = spark.createDataFrame([("2020-01-01", None), ("2020-02-01", None), ("2020-03-01", 1.0)], "date string, GDP double")
    out = found(etl.check_external(weather, economic))
    assert out[("weather", "between", "temp")] == 1 and out[("weather", "between", "humidity")] == 1
    assert out[("economic", "mostly_known", "GDP")] == 1
    assert etl.check_external(None, None) is None


def test_rules_report_absent_columns(spark):
    empty = spark.createDataFrame([(1,)], "other int")
    for dataset, rules in (
        ("prices", quality.price_rules), ("weather", quality.weather_rules), ("calendar", quality.calendar_rules),
        ("feature_store", quality.feature_store_rules), ("sales", quality.sales_rules),
    ):
        out = found(quality.run_rules(empty, dataset, rules(empty)))
        assert all(out[(dataset, "required_column", c)] == 1 for c in quality.REQUIRED[dataset])
    assert found(quality.run_rules(empty, "sales", quality.expectations(empty, "sales"))) == {("sales", "exists", "demand"): 1, ("sales", "exists", "date"): 1}
    assert found(quality.run_rules(empty, "weather", quality.expectations(empty, "weather"))) == {("weather", "exists", "temp"): 1}
    assert quality.duplicate_rule(empty, "sales").count() == 0
    assert quality.run_rules(empty, "sales", quality.threshold_rules(empty)).count() == 0
    assert etl.check_core(empty, empty, empty).where("rule = 'required_column' and violations = 1").count() == 17


def test_report(spark):
    rows = [("sales", "r", "c", 0, "error"), ("weather", "r", "c", 2, "error"), ("feature_store", "r", "c", 0, "error")]
    checked = spark.createDataFrame(rows, "dataset string, rule string, column string, violations long, severity string")
    families = {"core_data": ["sales"], "external_data": ["weather"], "processed_data": ["feature_store"]}
    row = quality.quality_report(checked, families).first()
    assert (row.total_checks, row.passed_checks, row.overall_status) == (3, 2, "FAIL")
    assert row.recommendations == quality.RECOMMENDATIONS["external_data"]
    good = quality.quality_report(checked.where(F.col("violations") == 0), families).first()
    assert good.overall_status == "PASS" and good.recommendations == ""


def test_payload_reading(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"state_id": "CA", "days": [
        {"datetime": "2020-01-01", "tempmax": 40.0, "tempmin": 20.0, "temp": 32.0, "precip": 0.0},
        {"datetime": "2020-01-02", "tempmax": 90.0, "tempmin": 70.0, "temp": 85.5, "precip": 1.0}]}))
    out = tables.read_weather(spark, str(tmp_path / "w.json")).orderBy("date").collect()
    assert [(r.temp_category, r.is_rainy, r.temp_range) for r in out] == [("freezing", 0, 20.0), ("hot", 1, 20.0)]
    (tmp_path / "e.json").write_text(json.dumps({"series_id": "GDP", "observations": [
        {"date": "2020-01-01", "value": "2.5"}, {"date": "2020-02-01", "value": "."}]}))
    out = tables.read_economic(spark, str(tmp_path / "e.json")).orderBy("date").collect()
    assert [r.value for r in out] == [2.5, None]


def test_wide_csv_to_panel(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\na_s,a,d,c,s,CA,3,0\n")
    days = tables.header_days(spark, str(path))
    out = tables.read_sales(spark, str(path), days).orderBy("day_num").collect()
    assert [(r.d, r.demand, r.day_num) for r in out] == [("d_1", 3, 1), ("d_2", 0, 2)]


def test_readable(spark, tmp_path):
    assert not tables.readable(spark.createDataFrame([], "a int"))
    assert tables.readable(spark.range(1))


def test_economic_fill(spark):
    long = spark.createDataFrame([("2020-01-01", "A", 1.0), ("2020-03-01", "B", 2.0), ("2020-02-01", "A", 5.0)], "date string, series_id string, value double")
    out = tables.economic_table(long, ["A", "B"]).orderBy("date").collect()
    assert [(r.A, r.B) for r in out] == [(1.0, None), (5.0, None), (5.0, 2.0)]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(32.0,), (32.5,), (85.0,), (None,)], "t double")
    labels = [r[0] for r in df.select(scalar.binned(F.col("t"), external.TEMPERATURE_EDGES, external.TEMPERATURE_LABELS)).collect()]
    assert labels == ["freezing", "cold", "warm", None]


def test_shared_folder_is_required_off_local(monkeypatch):
    from shelfspan import session

    class Conf:
        def get(self, _):
            return None

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.shared_folder(Fake())


def test_settle_reads_back_the_same_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    stored = settle(df)
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "shelfspan" in shared_path(spark, "x")


def test_feature_store_written_by_state(spark, small_panel, tmp_path):
    calendar = small_panel.select("d", "date").distinct().withColumns({
        "wm_yr_wk": F.weekofyear("date"), "event_name_1": F.when(F.dayofmonth("date") == 1, "x"), "event_type_1": F.lit(None).cast("string"),
        "event_name_2": F.lit(None).cast("string"), "event_type_2": F.lit(None).cast("string")})
    prices = small_panel.withColumn("wm_yr_wk", F.weekofyear("date")).groupBy("store_id", "item_id", "wm_yr_wk").agg(F.max("sell_price").alias("sell_price"))
    path = str(tmp_path / "store")
    etl.build_feature_store(small_panel.drop("date", "sell_price"), calendar, prices, path)
    out = tables.read_feature_store(spark, path)
    assert out.count() == 360 and {"demand_lag_28", "demand_rolling_std_28", "price_change", "is_holiday"} <= set(out.columns)
    assert out.where(F.col("is_holiday") == 1).select("date").distinct().count() == 3


def test_prices_are_read_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("item_id,store_id,sell_price,wm_yr_wk\nI1,S1,2.5,7\n")
    row = tables.read_prices(spark, str(tmp_path / "p.csv")).first()
    assert (row["store_id"], row["item_id"], row["wm_yr_wk"], row["sell_price"]) == ("S1", "I1", 7, 2.5)


def test_late_negative_day_is_found(spark):
    from shelfspan.operators import quality

    wide = spark.createDataFrame([("a", *[0] * 10, -1)], "id string, " + ", ".join(f"d_{n} int" for n in range(1, 12)))
    rules = [r for r in quality.sales_rules(wide) if r.column == "d_11"]
    found = {r["rule"]: r["violations"] for r in quality.run_rules(wide, "sales", rules).collect()}
    assert found["non_negative"] == 1


def test_completeness_of_an_empty_table(spark):
    from shelfspan.operators import profile

    assert [r["completeness"] for r in profile.completeness(spark.createDataFrame([], "a int")).collect()] == [None]
