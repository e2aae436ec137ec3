"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import quality
from shelfspan.operators.panel import date_gaps
from shelfspan.plans import etl, retail
from shelfspan.queries.base import ECONOMIC, WEATHER, i, query, with_panel, with_priced
from shelfspan.queries.joins import wide_months
from shelfspan.queries.windows import INDICATOR_NAMES, WIDE_ECONOMIC, economic
from shelfspan.session import settle, shared_path
from shelfspan.sources.tables import write_checked

DAYS = [f"d_{n}" for n in range(1, 32)]
FAMILIES = {
    "core_data": ["sales", "calendar", "prices"], "external_data": ["weather", "economic"], "processed_data": ["feature_store"],
}


def row(dataset: str, rule: str, column: str, expr: str, severity: str = "error", source: str = "") -> str:
    tail = f" FROM {source}" if source else ""
    return f"""SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{column}' AS "column", {i(expr, 'violations')}, '{severity}' AS severity{tail}"""


def rows_of(*selects: str) -> str:
    return " UNION ALL ".join(selects)


def count_if(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def required(dataset: str, absent: tuple[str, ...] = ()) -> list[str]:
    return [row(dataset, "required_column", c, str(int(c in absent))) for c in quality.REQUIRED[dataset]]


WIDE = "wide AS (SELECT id || '_' || strftime(date, '%Y%m') AS id, " + ", ".join(
    f"MAX(CASE WHEN day(date) = {n} THEN demand END) AS d_{n}" for n in range(1, 32)
) + " FROM panel GROUP BY 1)"
SALES_ROWS = [
    *required("sales"), row("sales", "day_columns", "d_*", "1", "warning"),
    *[x for c in DAYS for x in (row("sales", "numeric_type", c, "0"), row("sales", "non_negative", c, count_if(f"{c} < 0"), source="wide"))],
    row("sales", "unique", "id", "COUNT(*)", source="(SELECT id FROM wide GROUP BY id HAVING COUNT(*) > 1)"),
]


@query("v01_v05_sales_rules", with_panel(WIDE) + rows_of(*SALES_ROWS))
def sales_rules(spark, folder):
    wide = settle(wide_months(spark, folder), "wide")
    return quality.run_rules(wide, "sales", quality.sales_rules(wide)).unionByName(quality.duplicate_rule(wide, "sales"))


CALENDAR_ROWS = [
    *required("calendar"), row("calendar", "date_format", "date", count_if("date IS NULL"), source="calendar"),
    row("calendar", "starts_in_time", "date", "CASE WHEN MIN(date) > DATE '2011-01-29' THEN 1 ELSE 0 END", "warning", "calendar"),
    row("calendar", "ends_in_time", "date", "CASE WHEN MAX(date) < DATE '2016-05-22' THEN 1 ELSE 0 END", "warning", "calendar"),
    row("calendar", "no_gaps", "date", count_if("step <> 1"), "warning", "(SELECT date - LAG(date) OVER (ORDER BY date) AS step FROM calendar)"),
]


@query("v06_v08_calendar_rules", with_panel() + rows_of(*CALENDAR_ROWS))
def calendar_rules(spark, folder):
    days = settle(retail.calendar(spark, folder), "calendar")
    return quality.run_rules(days, "calendar", quality.calendar_rules(days)).unionByName(quality.gap_rule(date_gaps(days)))


@query(
    "v08_order_date_gaps",
    "WITH " + WEATHER + " " + row("weather", "no_gaps", "date", count_if("step <> 1"), "warning",
    "(SELECT date - LAG(date) OVER (PARTITION BY state_id ORDER BY date) AS step FROM weather)"),
)
def order_gaps(spark, folder):
    return quality.gap_rule(date_gaps(retail.weather(spark, folder), by=["state_id"]), "weather")


PRICE_ROWS = [
    *required("prices"), row("prices", "positive", "sell_price", count_if("sell_price <= 0"), source="prices"),
    row("prices", "not_extreme", "sell_price", count_if("sell_price > 1000"), "warning", "prices"),
    row("prices", "not_null", "sell_price", count_if("sell_price IS NULL"), "warning", "prices"),
]


@query("v09_price_rules", with_priced() + rows_of(*PRICE_ROWS))
def price_rules(spark, folder):
    table = retail.prices(spark, folder)
    return quality.run_rules(table, "prices", quality.price_rules(table))


WEATHER_ROWS = [
    *required("weather"), row("weather", "between", "temp", count_if("temp < -50 OR temp > 130"), "warning", "weather"),
    row("weather", "between", "humidity", count_if("humidity < 0 OR humidity > 100"), source="weather"),
]


@query("v10_weather_rules", "WITH " + WEATHER + " " + rows_of(*WEATHER_ROWS))
def weather_rules(spark, folder):
    table = retail.weather(spark, folder)
    return quality.run_rules(table, "weather", quality.weather_rules(table))


ECONOMIC_ROWS = [
    *required("economic"),
    *[row("economic", "mostly_known", c, f"CASE WHEN {count_if(f'{c} IS NULL')} > COUNT(*) * 0.5 THEN 1 ELSE 0 END", "warning", "economic") for c in INDICATOR_NAMES],
]


@query("v11_economic_rules", "WITH " + ECONOMIC + "," + WIDE_ECONOMIC + " " + rows_of(*ECONOMIC_ROWS))
def economic_rules(spark, folder):
    table = economic(spark, folder)
    return quality.run_rules(table, "economic", quality.economic_rules(table))


STORE_COLUMNS = ("id", "date", "demand", "item_id", "store_id", "raw_price", "demand_lag_28", "demand_rolling_std_7")
STORE = """
store AS (SELECT id, date, demand, item_id, store_id, raw_price,
  LAG(demand, 28) OVER (PARTITION BY id ORDER BY date) AS demand_lag_28,
  STDDEV_SAMP(demand) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS demand_rolling_std_7 FROM priced)"""
STORE_ROWS = [
    *required("feature_store"), row("feature_store", "non_negative", "demand", count_if("demand < 0"), source="store"),
    row("feature_store", "not_null", "demand", count_if("demand IS NULL"), "warning", "store"),
    row("feature_store", "lag_features", "*lag_*", "0", "warning"), row("feature_store", "rolling_features", "*rolling_*", "0", "warning"),
    *[row("feature_store", "complete", c, f"CASE WHEN COUNT({c}) * 100.0 / COUNT(*) < 90 THEN 1 ELSE 0 END", "warning", "store") for c in STORE_COLUMNS],
]


def store(spark, folder):
    from shelfspan.operators.demand import add_lags, add_rolling
    from shelfspan.operators.joins import join_calendar, join_prices

    dated = join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    df = join_prices(dated, retail.prices(spark, folder)).withColumnRenamed("sell_price", "raw_price")
    df = add_rolling(add_lags(df, [28], ["id"], detail=False), [7], ["id"], stats=["std"])
    return df.select(*STORE_COLUMNS)


@query("v12_v14_feature_store_rules", with_priced(STORE) + rows_of(*STORE_ROWS))
def store_rules(spark, folder):
    return etl.check_store(store(spark, folder))


@query("v12_v14_rules_while_writing", with_priced(STORE) + rows_of(*STORE_ROWS))
def store_rules_while_writing(spark, folder):
    """The same rules, counted by the job that writes the store."""
    rows = store(spark, folder)
    return write_checked(rows, shared_path(spark, "checked"), "feature_store", quality.feature_store_rules(rows))


SUITES = [
    row("sales", "exists", "demand", "0"), row("sales", "between", "demand", count_if("demand < 0"), source="panel"),
    row("sales", "exists", "date", "0"), row("sales", "not_null", "id", count_if("id IS NULL"), source="panel"),
    row("weather", "exists", "temp", "0"), row("weather", "between", "temp", count_if("temp < -50 OR temp > 130"), source="weather"),
    row("weather", "between", "humidity", count_if("humidity < 0 OR humidity > 100"), source="weather"),
]


def suites(spark, folder):
    frame, weather = retail.panel(spark, folder), retail.weather(spark, folder)
    return quality.run_rules(frame, "sales", quality.expectations(frame, "sales")).unionByName(
        quality.run_rules(weather, "weather", quality.expectations(weather, "weather"))
    )


@query("v15_expectation_suites", with_panel(WEATHER) + rows_of(*SUITES))
def expectation_rows(spark, folder):
    return suites(spark, folder)


@query(
    "v15_suite_result",
    with_panel(WEATHER, f"checked AS ({rows_of(*SUITES)})")
    + f"SELECT dataset, {i('COUNT(*)', 'expectations')}, {i(count_if('violations > 0'), 'failed')}, {i('CASE WHEN ' + count_if('violations > 0') + ' = 0 THEN 1 ELSE 0 END', 'success')} FROM checked GROUP BY dataset",
)
def suite_result(spark, folder):
    return quality.suite_result(suites(spark, folder))


BROKEN_SALES_ROWS = [
    *required("sales", ("state_id",)), row("sales", "day_columns", "d_*", "1", "warning"),
    *[row("sales", "numeric_type", c, str(int(c == "d_2"))) for c in DAYS],
    *[row("sales", "non_negative", c, "0" if c == "d_2" else "2 * " + count_if(f"{'-' if c == 'd_31' else ''}{c} < 0"), source="" if c == "d_2" else "wide") for c in DAYS],
    row("sales", "unique", "id", "COUNT(DISTINCT id)", source="wide"),
]


@query("v01_v05_broken_sales", with_panel(WIDE) + rows_of(*BROKEN_SALES_ROWS))
def broken_sales(spark, folder):
    """An absent column, a day column of text, negative sales on the last day, every row twice."""
    wide = settle(wide_months(spark, folder), "wide")
    broken = wide.drop("state_id").withColumns({"d_2": F.lit("x"), "d_31": -F.col("d_31")})
    broken = broken.unionByName(broken)
    return quality.run_rules(broken, "sales", quality.sales_rules(broken)).unionByName(quality.duplicate_rule(broken, "sales"))


BROKEN_ROWS = [
    *required("prices", ("sell_price",)),
    *required("weather", ("temp",)),
    row("weather", "between", "humidity", count_if("-humidity - 1 < 0 OR -humidity - 1 > 100"), source="weather"),
    row("calendar", "no_gaps", "date", count_if("step <> 1"), "warning", "(SELECT date - LAG(date) OVER (ORDER BY date) AS step FROM calendar WHERE day(date) <> 15)"),
    row("sales", "exists", "demand", "1"), row("sales", "exists", "date", "0"),
    row("sales", "not_null", "id", "COUNT(*)", source="panel"),
]


@query("v_broken_tables", with_panel(WEATHER) + rows_of(*BROKEN_ROWS))
def broken_tables(spark, folder):
    """Absent price, temperature and demand columns, impossible humidity, a calendar with holes, null ids."""
    prices = retail.prices(spark, folder).drop("sell_price")
    weather = retail.weather(spark, folder).drop("temp").withColumn("humidity", -F.col("humidity") - 1)
    days = retail.calendar(spark, folder).where(F.dayofmonth("date") != 15)
    frame = retail.panel(spark, folder).drop("demand").withColumn("id", F.lit(None).cast("string"))
    return etl._together([
        quality.run_rules(prices, "prices", quality.price_rules(prices)),
        quality.run_rules(weather, "weather", quality.weather_rules(weather)),
        quality.gap_rule(date_gaps(days)),
        quality.run_rules(frame, "sales", quality.expectations(frame, "sales")),
    ])


REPORT = with_priced(WIDE, STORE, WEATHER, ECONOMIC, WIDE_ECONOMIC, f"""
checked AS ({rows_of(*SALES_ROWS, *CALENDAR_ROWS, *PRICE_ROWS, *WEATHER_ROWS, *ECONOMIC_ROWS, *STORE_ROWS)}),
families AS (SELECT CASE WHEN dataset IN ('sales', 'calendar', 'prices') THEN 'core_data' WHEN dataset = 'feature_store' THEN 'processed_data'
                         ELSE 'external_data' END AS family, {count_if('violations > 0')} AS issues FROM checked GROUP BY 1),
advice AS (SELECT string_agg(CASE family WHEN 'core_data' THEN '{quality.RECOMMENDATIONS['core_data']}'
             WHEN 'external_data' THEN '{quality.RECOMMENDATIONS['external_data']}' ELSE '{quality.RECOMMENDATIONS['processed_data']}' END, '; '
             ORDER BY CASE family WHEN 'core_data' THEN 'L' WHEN 'external_data' THEN 'C' ELSE 'B' END) AS recommendations
           FROM families WHERE issues > 0)""")


@query(
    "v16_quality_report",
    REPORT + f"""SELECT {i('COUNT(*)', 'total_checks')}, {i(count_if('issues = 0'), 'passed_checks')},
      round({count_if('issues = 0')} * 100.0 / COUNT(*), 6) AS success_rate,
      CASE WHEN {count_if('issues = 0')} = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS overall_status,
      COALESCE(MAX(recommendations), '') AS recommendations FROM families CROSS JOIN advice""",
)
def report(spark, folder):
    wide = settle(wide_months(spark, folder), "wide")
    days = settle(retail.calendar(spark, folder), "calendar")
    core = etl.check_core(wide, days, retail.prices(spark, folder))
    outside = etl.check_external(retail.weather(spark, folder), economic(spark, folder))
    return quality.quality_report(core.unionByName(outside).unionByName(etl.check_store(store(spark, folder))), FAMILIES)


@query(
    "v17_threshold_rules",
    with_panel() + rows_of(
        row("sales", "max_missing", "demand", f"CASE WHEN {count_if('demand IS NULL')} > COUNT(*) * 0.05 THEN 1 ELSE 0 END", "warning", "panel"),
        row("sales", "min_value", "demand", count_if("demand < 0"), source="panel"),
        row("sales", "max_value", "demand", count_if("demand > 100000"), source="panel"),
    ),
)
def thresholds(spark, folder):
    frame = retail.panel(spark, folder)
    return quality.run_rules(frame, "sales", quality.threshold_rules(frame))
