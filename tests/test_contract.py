"""The driver contract, and oracle checks at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check_queries import TABLES, compare
from shelfspan.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "w06_rolling_std", "w10_adjusted_ewm", "w16_price_fill", "e10_error_percentiles", "e20_forecast_value", "c02_codes_with_unknown",
    "s06_weather_json", "w_events_panel_windows",
]
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_registry():
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 120
    without = set(QUERIES) - set(ORACLES)
    assert all(name.startswith(("m", "s12", "s13", "r09", "c05")) for name in without)


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert compare(got, db.execute(contract.oracle_sql()[name]).fetchdf()) == "ok"


@needs_data
def test_chain_has_all_columns_and_one_series_exchange(spark):
    from shelfspan.plans import features, retail

    chain = features.forecasting_features(retail.sales(spark, FOLDER), retail.calendar(spark, FOLDER), retail.prices(spark, FOLDER))
    assert len(chain.columns) == 132
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
