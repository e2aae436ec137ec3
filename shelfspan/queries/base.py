"""Registry, output normalisation and shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def conform(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain types for comparison: bigint, rounded double, text."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("int").cast("long")
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(field.dataType, (T.FractionalType)):
            c = F.round(c.cast("double"), digits)
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a query, and the SQL that must give the same rows."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: conform(build(spark, folder), digits)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def d(expr: str, name: str | None = None) -> str:
    return f"strftime(CAST({expr} AS DATE), '%Y-%m-%d') AS {name or expr}"


def i(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def f(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name or expr}"


def s(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def cols(*parts: str) -> str:
    return ", ".join(parts)


BOUNDS = "bounds AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)"

LINES = """
lines AS (
  SELECT p_brand AS item_id, r_name AS store_id,
         CASE r_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'WI' END AS state_id,
         CAST(l_shipdate AS DATE) AS date, l_quantity AS quantity, floor(l_extendedprice / l_quantity * 100) / 100 AS unit_price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CALENDAR = """
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds),
calendar AS (
  SELECT date, CAST((date - lo) // 7 + 1 AS INTEGER) AS wm_yr_wk, dayname(date) AS weekday,
         isodow(date) AS wday, month(date) AS month, year(date) AS year, 'd_' || (date - lo + 1) AS d,
         CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'NewYear' WHEN '02-14' THEN 'ValentinesDay'
              WHEN '05-05' THEN 'CincoDeMayo' WHEN '07-04' THEN 'IndependenceDay'
              WHEN '10-31' THEN 'Halloween' WHEN '12-25' THEN 'Christmas' END AS event_name_1,
         CASE WHEN strftime(date, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 'National'
              WHEN strftime(date, '%m-%d') IN ('02-14', '05-05', '10-31') THEN 'Cultural' END AS event_type_1,
         CASE strftime(date, '%m-%d') WHEN '12-25' THEN 'WinterFestival' WHEN '05-05' THEN 'SpringFair' END AS event_name_2,
         CASE strftime(date, '%m-%d') WHEN '12-25' THEN 'Religious' WHEN '05-05' THEN 'Cultural' END AS event_type_2,
         CASE WHEN day(date) % 5 = 0 THEN 1 ELSE 0 END AS snap_CA,
         CASE WHEN (day(date) + 1) % 5 = 0 THEN 1 ELSE 0 END AS snap_TX,
         CASE WHEN (day(date) + 2) % 5 = 0 THEN 1 ELSE 0 END AS snap_WI
  FROM days)"""

PANEL = """
panel AS (
  SELECT s.item_id || '_' || s.store_id AS id, s.item_id,
         'CAT_' || (b % 3) || '_' || (b % 2) AS dept_id, 'CAT_' || (b % 3) AS cat_id,
         s.store_id, s.state_id, c.d, CAST(COALESCE(q.q, 0) AS BIGINT) AS demand,
         CAST(c.date - c.lo + 1 AS INTEGER) AS day_num, c.date
  FROM (SELECT DISTINCT item_id, store_id, state_id,
               CAST(regexp_extract(item_id, '([0-9]+)', 1) AS INTEGER) AS b FROM lines) s
  CROSS JOIN (SELECT date, lo, 'd_' || (date - lo + 1) AS d FROM days) c
  LEFT JOIN (SELECT item_id, store_id, date, SUM(quantity) AS q FROM lines GROUP BY 1, 2, 3) q
    ON q.item_id = s.item_id AND q.store_id = s.store_id AND q.date = c.date)"""

PRICES = """
prices AS (
  SELECT store_id, item_id, CAST((date - lo) // 7 + 1 AS INTEGER) AS wm_yr_wk, MAX(unit_price) AS sell_price
  FROM lines CROSS JOIN bounds GROUP BY 1, 2, 3)"""

PRICED = """
priced AS (
  SELECT *, COALESCE(
           last_value(raw_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(raw_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS sell_price
  FROM (SELECT p.*, c.wm_yr_wk, pr.sell_price AS raw_price
        FROM panel p JOIN calendar c ON p.d = c.d
        LEFT JOIN prices pr ON pr.store_id = p.store_id AND pr.item_id = p.item_id AND pr.wm_yr_wk = c.wm_yr_wk))"""

WEATHER = """
weather AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE n_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'WI' END AS state_id,
         MAX(o_totalprice) / 5000 AS tempmax, MIN(o_totalprice) / 5000 AS tempmin,
         (MAX(o_totalprice) + MIN(o_totalprice)) / 10000 AS temp,
         CAST(COUNT(*) * 7 % 101 AS DOUBLE) AS humidity,
         CAST(COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS precip,
         CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) AS windspeed,
         CAST(COUNT(*) * 3 % 101 AS DOUBLE) AS cloudcover,
         CASE WHEN COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') > 0 THEN 'Rain' ELSE 'Clear' END AS conditions
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""

ECONOMIC = """
economic_long AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CASE o_orderstatus WHEN 'O' THEN 'UNRATE' WHEN 'F' THEN 'UMCSENT' WHEN 'P' THEN 'CPIAUCSL' END AS series_id,
         CAST(COUNT(*) AS DOUBLE) AS value
  FROM orders WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY 1, 2)"""

FORECAST = """
forecast AS (
  SELECT store_id, item_id, cat_id, date, model, y_true, y_pred FROM (
    SELECT store_id, item_id, cat_id, date, CAST(demand AS DOUBLE) AS y_true,
           CAST(COALESCE(LAG(demand) OVER w, 0) AS DOUBLE) AS naive,
           COALESCE(AVG(demand) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0) AS ma7
    FROM panel WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date))
  UNPIVOT (y_pred FOR model IN (naive, ma7)))"""

EVENT_PANEL = """
ebounds AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events),
edays AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM ebounds),
epanel AS (
  SELECT s.store_id, s.item_id, c.date, CAST(COALESCE(q.n, 0) AS BIGINT) AS demand
  FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS store_id, event_type AS item_id FROM events) s
  CROSS JOIN edays c
  LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS store_id, event_type AS item_id, CAST(ts AS DATE) AS date, COUNT(*) AS n
             FROM events GROUP BY 1, 2, 3) q
    ON q.store_id = s.store_id AND q.item_id = s.item_id AND q.date = c.date)"""


def with_panel(*extra: str) -> str:
    return "WITH " + ",".join([BOUNDS, LINES, CALENDAR, PANEL, *extra]) + "\n"


def with_priced(*extra: str) -> str:
    return with_panel(PRICES, PRICED, *extra)


def with_forecast(*extra: str) -> str:
    return with_panel(FORECAST, *extra)


KEY = cols("store_id", "item_id", d("date"))
OVER = "PARTITION BY store_id, item_id ORDER BY date"


def rows(n: int, shift: int = 0) -> str:
    end = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    return f"({OVER} ROWS BETWEEN {n - 1 + shift} PRECEDING AND {end})"
