"""Window feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import demand, price
from shelfspan.operators.external import add_indicator_trends
from shelfspan.operators.joins import join_calendar, join_prices
from shelfspan.operators.joins import outer_chain
from shelfspan.operators.panel import date_gaps, fill_indicators
from shelfspan.plans import retail
from shelfspan.queries.base import (
    ECONOMIC, EVENT_PANEL, KEY, OVER, WEATHER, cols, d, f, i, query, rows, with_panel, with_priced,
)
from shelfspan.schemas import (
    ACTIVE_WINDOWS, EWM_ALPHAS, EWM_SPANS, LAGS, MOMENTUM_WINDOWS, PATTERN_WINDOWS, WINDOWS,
)

KEYS = ["store_id", "item_id", "date"]


def narrow(spark, folder):
    return retail.panel(spark, folder).select(*KEYS, "demand")


def priced(spark, folder):
    dated = join_calendar(
        retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk")
    )
    return price.fill_prices(join_prices(dated, retail.prices(spark, folder)))


def panel_sql(*parts: str) -> str:
    return with_panel() + f"SELECT {cols(KEY, *parts)} FROM panel"


def priced_sql(*parts: str) -> str:
    return with_priced() + f"SELECT {cols(KEY, *parts)} FROM priced"


LAG = "LAG(demand, {n}) OVER (" + OVER + ")"


@query("w01_lags", panel_sql(i("demand"), *[i(LAG.format(n=n), f"demand_lag_{n}") for n in LAGS]))
def lags(spark, folder):
    return demand.add_lags(narrow(spark, folder), detail=False)


@query("w02_log_lags", panel_sql(*[f(f"ln(1 + {LAG.format(n=n)})", f"demand_lag_{n}_log") for n in LAGS]))
def log_lags(spark, folder):
    full = demand.add_lags(narrow(spark, folder))
    return full.select(*KEYS, *[f"demand_lag_{n}_log" for n in LAGS])


@query(
    "w03_nonzero_lag_flags",
    panel_sql(*[i(f"CASE WHEN {LAG.format(n=n)} > 0 THEN 1 ELSE 0 END", f"demand_lag_{n}_nonzero") for n in LAGS]),
)
def lag_flags(spark, folder):
    full = demand.add_lags(narrow(spark, folder))
    return full.select(*KEYS, *[f"demand_lag_{n}_nonzero" for n in LAGS])


@query(
    "w04_active_days",
    panel_sql(*[i(f"SUM(CASE WHEN demand > 0 THEN 1 ELSE 0 END) OVER {rows(n)}", f"active_days_last_{n}") for n in ACTIVE_WINDOWS]),
)
def active_days(spark, folder):
    return demand.add_activity(narrow(spark, folder)).drop("demand")


@query("w05_rolling_mean", panel_sql(*[f(f"AVG(demand) OVER {rows(n)}", f"demand_rolling_mean_{n}") for n in WINDOWS]))
def rolling_mean(spark, folder):
    return demand.add_rolling(narrow(spark, folder), stats=["mean"]).drop("demand")


@query("w06_rolling_std", panel_sql(*[f(f"STDDEV_SAMP(demand) OVER {rows(n)}", f"demand_rolling_std_{n}") for n in WINDOWS]))
def rolling_std(spark, folder):
    return demand.add_rolling(narrow(spark, folder), stats=["std"]).drop("demand")


@query(
    "w07_rolling_max_min",
    panel_sql(
        *[i(f"MAX(demand) OVER {rows(n)}", f"demand_rolling_max_{n}") for n in WINDOWS],
        *[i(f"MIN(demand) OVER {rows(n)}", f"demand_rolling_min_{n}") for n in WINDOWS],
    ),
)
def rolling_extremes(spark, folder):
    return demand.add_rolling(narrow(spark, folder), stats=["max", "min"]).drop("demand")


def _mean(n):
    return f"AVG(demand) OVER {rows(n)}"


def _std(n):
    return f"STDDEV_SAMP(demand) OVER {rows(n)}"


@query("w08_rolling_cv", panel_sql(*[f(f"({_std(n)}) / ({_mean(n)} + 1e-8)", f"demand_rolling_cv_{n}", 4) for n in WINDOWS]), digits=4)
def rolling_cv(spark, folder):
    full = demand.add_spread(demand.add_rolling(narrow(spark, folder), stats=["mean", "std"]))
    return full.select(*KEYS, *[f"demand_rolling_cv_{n}" for n in WINDOWS])


@query(
    "w09_rolling_trend",
    panel_sql(*[f(f"(demand - {_mean(n)}) / ({_std(n)} + 1e-8)", f"demand_trend_{n}", 4) for n in WINDOWS]),
    digits=4,
)
def rolling_trend(spark, folder):
    full = demand.add_spread(demand.add_rolling(narrow(spark, folder), stats=["mean", "std"]))
    return full.select(*KEYS, *[f"demand_trend_{n}" for n in WINDOWS])


def ewm_sql(table: str, head: str) -> str:
    """Direct weighted sums over a frame long enough for double precision."""
    depth = {0.1: 372, 0.3: 110, 0.5: 57}
    parts, weights = [], []
    for a in EWM_ALPHAS:
        name = str(a).replace(".", "_")
        k = depth[a]
        weights.append(f"[pow({1 - a!r}, {k} - x) FOR x IN range(0, {k + 1})] AS w_{name}")
        values = f"list(CAST(demand AS DOUBLE)) OVER ({OVER} ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
        parts.append(f"{values} AS l_{name}")
    out = []
    for a in EWM_ALPHAS:
        name = str(a).replace(".", "_")
        tail = f"list_slice(w_{name}, -len(l_{name}), -1)"
        out.append(f(f"list_inner_product(l_{name}, {tail}) / list_sum({tail}) + 1e-9", f"demand_ewm_{name}"))
    return head + f"""SELECT {cols(KEY, *out)} FROM
      (SELECT store_id, item_id, date, {cols(*parts)} FROM {table}) CROSS JOIN (SELECT {cols(*weights)})"""


def nudged_ewm(df):
    """Early rows give exact halves at the compared digit; both sides are nudged off them."""
    names = [c for c in df.columns if "_ewm_" in c]
    return df.select(*KEYS, *[(F.col(c) + 1e-9).alias(c) for c in names])


@query("w10_adjusted_ewm", ewm_sql("panel", with_panel()))
def adjusted_ewm(spark, folder):
    return nudged_ewm(demand.add_ewm(narrow(spark, folder)))


def _recursive_sql() -> str:
    step = [f"{2.0 / (n + 1)!r} * p.demand + (1 - {2.0 / (n + 1)!r}) * r.e{n} AS e{n}" for n in EWM_SPANS]
    start = [f"CAST(demand AS DOUBLE) AS e{n}" for n in EWM_SPANS]
    return (
        "WITH RECURSIVE " + with_panel()[5:].rstrip() + f""",
    smooth AS (
      SELECT store_id, item_id, date, day_num, {cols(*start)} FROM panel WHERE day_num = 1
      UNION ALL
      SELECT p.store_id, p.item_id, p.date, p.day_num, {cols(*step)}
      FROM smooth r JOIN panel p ON p.store_id = r.store_id AND p.item_id = r.item_id AND p.day_num = r.day_num + 1)
    SELECT {cols(KEY, *[f(f"e{n} + 1e-9", f"demand_ewm_{n}") for n in EWM_SPANS])} FROM smooth"""
    )


@query("w11_recursive_ewm", _recursive_sql())
def recursive_ewm(spark, folder):
    return nudged_ewm(demand.add_recursive_ewm(narrow(spark, folder)))


@query(
    "w12_intermittency_ratio",
    panel_sql(*[f(f"AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) OVER {rows(n)}", f"intermittency_ratio_{n}") for n in PATTERN_WINDOWS]),
)
def intermittency(spark, folder):
    full = demand.add_intermittency(narrow(spark, folder))
    return full.select(*KEYS, *[f"intermittency_ratio_{n}" for n in PATTERN_WINDOWS])


@query(
    "w13_demand_intensity",
    panel_sql(*[f(f"COALESCE(AVG(CASE WHEN demand > 0 THEN demand END) OVER {rows(n)}, 0)", f"demand_intensity_{n}") for n in PATTERN_WINDOWS]),
)
def intensity(spark, folder):
    full = demand.add_intermittency(narrow(spark, folder))
    return full.select(*KEYS, *[f"demand_intensity_{n}" for n in PATTERN_WINDOWS])


@query(
    "w14_demand_velocity",
    panel_sql(*[f(f"{_mean(a)} - {_mean(b)}", f"demand_velocity_{a}_{b}") for a, b in ((7, 14), (14, 28), (28, 56))]),
)
def velocity(spark, folder):
    full = demand.add_velocity(demand.add_rolling(narrow(spark, folder), stats=["mean"]))
    return full.select(*KEYS, *[f"demand_velocity_{a}_{b}" for a, b in ((7, 14), (14, 28), (28, 56))])


LAST_SALE = f"MAX(CASE WHEN demand > 0 THEN date END) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("w15_days_since_last_sale", panel_sql(i(f"COALESCE(date - {LAST_SALE}, 999)", "days_since_last_sale")))
def days_since_sale(spark, folder):
    return demand.add_days_since_sale(narrow(spark, folder)).drop("demand")


@query("j09_last_sale_as_of", panel_sql(d(LAST_SALE, "last_sale")))
def last_sale(spark, folder):
    return narrow(spark, folder).select(*KEYS, demand.last_sale_before().alias("last_sale"))


@query("w16_price_fill", priced_sql(i("wm_yr_wk"), f("raw_price"), f("sell_price")))
def price_fill(spark, folder):
    dated = join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    raw = join_prices(dated, retail.prices(spark, folder)).withColumn("raw_price", F.col("sell_price"))
    return price.fill_prices(raw).select(*KEYS, "wm_yr_wk", "raw_price", "sell_price")


INDICATOR_NAMES = ("UNRATE", "UMCSENT", "CPIAUCSL")
WIDE_ECONOMIC = """
economic AS (
  SELECT date, {fills} FROM (
    SELECT date, {picks} FROM economic_long GROUP BY date))""".format(
    fills=", ".join(
        f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in INDICATOR_NAMES
    ),
    picks=", ".join(f"MAX(CASE WHEN series_id = '{c}' THEN value END) AS {c}" for c in INDICATOR_NAMES),
)
ECONOMIC_WITH = "WITH " + ECONOMIC + "," + WIDE_ECONOMIC


def economic(spark, folder):
    long = retail.economic_long(spark, folder)
    tables = [
        long.where(F.col("series_id") == c).select("date", F.col("value").alias(c)) for c in INDICATOR_NAMES
    ]
    return fill_indicators(outer_chain(tables), INDICATOR_NAMES)


@query("w17_indicator_forward_fill", ECONOMIC_WITH + f" SELECT {cols(d('date'), *[f(c) for c in INDICATOR_NAMES])} FROM economic")
def indicator_fill(spark, folder):
    return economic(spark, folder)


PREVIOUS = f"LAG(sell_price) OVER ({OVER})"


@query("w18_price_change", priced_sql(f(f"sell_price - {PREVIOUS}", "price_change")))
def price_change(spark, folder):
    return priced(spark, folder).select(*KEYS, price.change("sell_price").alias("price_change"))


@query("w19_price_change_pct", priced_sql(f(f"sell_price / {PREVIOUS} - 1", "price_change_pct")))
def price_change_pct(spark, folder):
    full = price.add_relative_change(priced(spark, folder), "price_change_pct", "sell_price")
    return full.select(*KEYS, "price_change_pct")


@query("w20_price_change_abs", priced_sql(f(f"abs(sell_price / {PREVIOUS} - 1)", "price_change_abs")))
def price_change_abs(spark, folder):
    full = price.add_relative_change(priced(spark, folder), "price_change", "sell_price")
    return full.select(*KEYS, F.abs("price_change").alias("price_change_abs"))


@query(
    "w21_price_momentum",
    priced_sql(*[
        f(f"CASE WHEN COUNT(sell_price) OVER {rows(n)} = {n} THEN AVG(sell_price) OVER {rows(n)} END", f"price_momentum_{n}", 4)
        for n in MOMENTUM_WINDOWS
    ]),
    digits=4,
)
def momentum(spark, folder):
    full = price.add_price_windows(priced(spark, folder))
    return full.select(*KEYS, *[f"price_momentum_{n}" for n in MOMENTUM_WINDOWS])


@query(
    "w22_price_rolling_mean",
    priced_sql(
        f(f"AVG(sell_price) OVER {rows(28)}", "price_rolling_mean_28"),
        f(f"sell_price / AVG(sell_price) OVER {rows(28)}", "price_relative_to_avg"),
    ),
)
def price_rolling(spark, folder):
    full = price.add_rolling_price(priced(spark, folder))
    return full.select(*KEYS, "price_rolling_mean_28", "price_relative_to_avg")


MONTHLY_STATE = """
state_month AS (
  SELECT CASE n_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'WI' END AS state_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS UNRATE
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""
STATE_OVER = "PARTITION BY state_id ORDER BY date"


def state_month(spark, folder):
    """A monthly indicator per state: its order count."""
    orders = retail.table(spark, folder, "orders").select("o_custkey", F.to_date(F.trunc("o_orderdate", "MM")).alias("date"))
    customer = retail.table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = retail.table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    keyed = orders.join(customer, "o_custkey").join(nation, "n_nationkey")
    state = retail.state_of(F.col("n_regionkey")).alias("state_id")
    return keyed.groupBy(state, "date").agg(F.count(F.lit(1)).cast("double").alias("UNRATE"))


@query(
    "w23_w24_indicator_trends",
    "WITH " + MONTHLY_STATE + f""" SELECT {cols('state_id', d('date'), f('UNRATE'),
      f(f'UNRATE / LAG(UNRATE, 12) OVER ({STATE_OVER}) - 1', 'UNRATE_trend'),
      f(f'CASE WHEN COUNT(*) OVER ({STATE_OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 '
        f'THEN AVG(UNRATE) OVER ({STATE_OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END', 'UNRATE_ma_3'))}
    FROM state_month""",
)
def indicator_trends(spark, folder):
    return add_indicator_trends(state_month(spark, folder), ["UNRATE"], ["state_id"])


@query(
    "w25_calendar_gaps",
    "WITH " + WEATHER + f""" SELECT {cols('state_id', d('date'), i('step_days'))} FROM (
      SELECT state_id, date, date - LAG(date) OVER ({STATE_OVER}) AS step_days FROM weather) WHERE step_days <> 1""",
)
def gaps(spark, folder):
    return date_gaps(retail.weather(spark, folder), by=["state_id"])


@query("w26_naive_forecast", panel_sql(i("demand"), i(f"COALESCE({LAG.format(n=1)}, 0)", "naive")))
def naive(spark, folder):
    return narrow(spark, folder).withColumn("naive", demand.naive_forecast())


@query("w27_day_number", with_panel() + f"SELECT {cols('id', 'd', i('day_num'))} FROM panel")
def day_number(spark, folder):
    return retail.sales(spark, folder).select("id", "d", F.regexp_extract("d", "([0-9]+)", 1).cast("int").alias("day_num"))


@query(
    "w_events_panel_windows",
    "WITH " + EVENT_PANEL + f""" SELECT {cols(KEY, i('demand'), i(LAG.format(n=7), 'demand_lag_7'),
      f(f'AVG(demand) OVER {rows(7)}', 'demand_rolling_mean_7'), f(f'STDDEV_SAMP(demand) OVER {rows(7)}', 'demand_rolling_std_7'),
      i(f'COALESCE(date - {LAST_SALE}, 999)', 'days_since_last_sale'))} FROM epanel""",
)
def event_windows(spark, folder):
    df = demand.add_lags(retail.event_panel(spark, folder), lags=[7], detail=False)
    return demand.add_days_since_sale(demand.add_rolling(df, windows=[7], stats=["mean", "std"]))


@query("w_events_panel_ewm", ewm_sql("epanel", "WITH " + EVENT_PANEL + " "))
def event_ewm(spark, folder):
    return nudged_ewm(demand.add_ewm(retail.event_panel(spark, folder)))


@query(
    "w_shifted_rolling",
    panel_sql(*[f(f"AVG(demand) OVER {rows(n, 1)}", f"demand_rolling_mean_{n}") for n in WINDOWS]),
)
def shifted_rolling(spark, folder):
    """Leak-free frames: the current day is left out."""
    return demand.add_rolling(narrow(spark, folder), stats=["mean"], shift=1).drop("demand")
