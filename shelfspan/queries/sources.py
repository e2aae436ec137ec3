"""Source and sink round trips over derived tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import evaluate as ev
from shelfspan.operators import profile, quality

from shelfspan.plans import retail
from shelfspan.queries.aggregates import SUMMARY
from shelfspan.queries.base import (
    ECONOMIC, WEATHER, cols, d, f, i, query, with_panel, with_priced,
)
from shelfspan.queries.evaluation import METRIC_TABLE
from shelfspan.queries.joins import MELTED, wide_months
from shelfspan.queries.scalars import CATEGORY, PARTS, flags
from shelfspan.queries.windows import INDICATOR_NAMES, WIDE_ECONOMIC, priced
from shelfspan.session import shared_path
from shelfspan.sources import tables


@query("s01_wide_sales_csv", MELTED)
def wide_sales(spark, folder):
    path = shared_path(spark, "wide")
    tables.write_table(wide_months(spark, folder), path, form="csv")
    sales = tables.read_sales(spark, path, [f"d_{n}" for n in range(1, 32)])
    return sales.where(F.col("demand").isNotNull())


EVENTS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")


@query(
    "s02_calendar_csv",
    with_panel() + f"""SELECT {cols(d('date'), i('wm_yr_wk'), 'weekday', i('wday'), 'd', *EVENTS, i('snap_CA'), i('snap_TX'), i('snap_WI'),
      *[i(x, n) for n, x in PARTS.items()], *flags({f'{c}_exists': f'{c} IS NOT NULL' for c in EVENTS}))} FROM calendar""",
)
def calendar(spark, folder):
    path = shared_path(spark, "calendar")
    tables.write_table(retail.calendar(spark, folder), path, form="csv")
    return tables.read_calendar(spark, path)


@query("s03_prices_csv", with_priced() + f"SELECT store_id, item_id, {i('wm_yr_wk')}, {f('sell_price')} FROM prices")
def prices(spark, folder):
    path = shared_path(spark, "prices")
    tables.write_table(retail.prices(spark, folder), path, form="csv")
    return tables.read_prices(spark, path)


@query(
    "s05_source_presence",
    " UNION ALL ".join(f"SELECT '{t}' AS dataset, CAST(COUNT(*) > 0 AS BIGINT) AS present FROM {t}" for t in ("lineitem", "orders", "events")),
)
def presence(spark, folder):
    checks = [
        quality.run_rules(retail.table(spark, folder, t), t, [quality.Rule("present", "*", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))])
        for t in ("lineitem", "orders", "events")
    ]
    merged = checks[0].unionByName(checks[1]).unionByName(checks[2])
    return merged.select("dataset", (1 - F.col("violations")).alias("present"))


MEASURES = ("tempmax", "tempmin", "temp", "humidity", "precip", "windspeed", "cloudcover")


@query(
    "s06_weather_json",
    "WITH " + WEATHER + f""" SELECT {cols('state_id', d('date'), *[f(c) for c in MEASURES], 'conditions', f('tempmax - tempmin', 'temp_range'),
      i('CASE WHEN precip > 0 THEN 1 ELSE 0 END', 'is_rainy'), CATEGORY + ' AS temp_category')} FROM weather""",
)
def weather_json(spark, folder):
    path = shared_path(spark, "weather")
    tables.weather_payload(retail.weather(spark, folder)).write.json(path)
    return tables.read_weather(spark, path)


@query("s07_economic_json", "WITH " + ECONOMIC + f" SELECT {d('date')}, series_id, {f('value')} FROM economic_long")
def economic_json(spark, folder):
    path = shared_path(spark, "economic")
    tables.economic_payload(retail.economic_long(spark, folder)).write.json(path)
    return tables.read_economic(spark, path)


@query("s07_economic_table", "WITH " + ECONOMIC + "," + WIDE_ECONOMIC + f" SELECT {cols(d('date'), *[f(c) for c in INDICATOR_NAMES])} FROM economic")
def economic_table(spark, folder):
    return tables.economic_table(retail.economic_long(spark, folder), INDICATOR_NAMES)


@query(
    "s09_s10_feature_store_table",
    with_priced() + f"SELECT {cols('id', 'state_id', d('date'), i('demand'), f('sell_price'), i('year(date)', 'year'))} FROM priced",
)
def feature_store(spark, folder):
    path = shared_path(spark, "store")
    rows = priced(spark, folder).select("id", "state_id", "date", "demand", "sell_price", F.year("date").alias("year"))
    tables.write_table(rows.repartition("state_id", "year"), path, by=["state_id", "year"])
    return tables.read_feature_store(spark, path)


@query("s11_results_json", METRIC_TABLE + f"SELECT model, metric, {f('value')} FROM metrics UNPIVOT (value FOR metric IN (rmse, mae, r2))")
def results(spark, folder):
    path = shared_path(spark, "results")
    metrics = ev.evaluate(retail.forecast(spark, folder)).select("model", "rmse", "mae", "r2")
    tables.write_results(ev.metric_rows(metrics), path)
    return tables.read_results(spark, path, "model string, metric string, value double")


@query("s14_exploration_summary", with_priced() + SUMMARY)
def summary(spark, folder):
    path = shared_path(spark, "summary")
    table = profile.summary(retail.panel(spark, folder), retail.prices(spark, folder))
    tables.write_summary(table, path)
    return spark.read.schema(table.schema).json(path)


ETL = """
etl AS (SELECT p.*, w.temp, w.humidity, w.precip, w.windspeed, e.UNRATE, e.UMCSENT, e.CPIAUCSL FROM priced p
        LEFT JOIN weather w ON w.date = p.date AND w.state_id = p.state_id
        LEFT JOIN economic e ON e.date = date_trunc('month', p.date))"""


@query(
    "etl_integrated_panel",
    with_priced(WEATHER, ECONOMIC, WIDE_ECONOMIC, ETL)
    + f"""SELECT {cols('id', d('date'), i('demand'), i('wm_yr_wk'), f('raw_price', 'sell_price'),
      *[f(c) for c in ('temp', 'humidity', 'precip', 'windspeed', *INDICATOR_NAMES)])} FROM etl""",
)
def integrated(spark, folder):
    from shelfspan.plans.etl import integrate

    joined = integrate(
        retail.sales(spark, folder), retail.calendar(spark, folder), retail.prices(spark, folder), retail.weather(spark, folder),
        tables.economic_table(retail.economic_long(spark, folder), INDICATOR_NAMES),
    )
    return joined.select("id", "date", "demand", "wm_yr_wk", "sell_price", "temp", "humidity", "precip", "windspeed", *INDICATOR_NAMES)
