"""Join, reshape and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import joins, ordering, panel as reshape, prepare
from shelfspan.operators.business import add_item_age, add_seasonal_strength, add_store_performance
from shelfspan.plans import retail
from shelfspan.queries.aggregates import MONTHLY
from shelfspan.queries.base import ECONOMIC, KEY, WEATHER, cols, d, f, i, query, with_panel, with_priced
from shelfspan.queries.windows import INDICATOR_NAMES, KEYS, WIDE_ECONOMIC, economic, priced

EVENTS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")


@query(
    "j01_sales_calendar",
    with_panel() + f"""SELECT {cols('p.id', 'p.d', i('p.demand', 'demand'), d('c.date', 'date'), i('c.wm_yr_wk', 'wm_yr_wk'),
      'c.weekday', *[f'c.{e}' for e in EVENTS], i('c.snap_CA', 'snap_CA'))} FROM panel p LEFT JOIN calendar c ON c.d = p.d""",
)
def sales_calendar(spark, folder):
    joined = joins.join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder))
    return joined.select("id", "d", "demand", "date", "wm_yr_wk", "weekday", *EVENTS, "snap_CA")


@query("j02_sales_prices", with_priced() + f"SELECT {cols('id', d('date'), i('wm_yr_wk'), f('raw_price', 'sell_price'))} FROM priced")
def sales_prices(spark, folder):
    dated = joins.join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    return joins.join_prices(dated, retail.prices(spark, folder)).select("id", "date", "wm_yr_wk", "sell_price")


SIGNALS = ("temp", "humidity", "precip", "windspeed")


@query(
    "j03_sales_weather",
    with_panel(WEATHER) + f"""SELECT {cols('p.id', d('p.date', 'date'), *[f(f'w.{c}', c) for c in SIGNALS])}
      FROM panel p LEFT JOIN weather w ON w.date = p.date AND w.state_id = p.state_id""",
)
def sales_weather(spark, folder):
    return joins.join_weather(retail.panel(spark, folder), retail.weather(spark, folder)).select("id", "date", *SIGNALS)


@query(
    "j04_sales_economic",
    with_panel(ECONOMIC, WIDE_ECONOMIC) + f"""SELECT {cols('p.id', d('p.date', 'date'), *[f(f'e.{c}', c) for c in INDICATOR_NAMES])}
      FROM panel p LEFT JOIN economic e ON e.date = date_trunc('month', p.date)""",
)
def sales_economic(spark, folder):
    joined = joins.join_economic(retail.panel(spark, folder), economic(spark, folder))
    return joined.select("id", "date", *INDICATOR_NAMES)


@query(
    "j05_outer_chain",
    "WITH " + ECONOMIC + f""" SELECT {cols(d('date'), *[f(f"MAX(CASE WHEN series_id = '{c}' THEN value END)", c) for c in INDICATOR_NAMES])}
      FROM economic_long GROUP BY economic_long.date""",
)
def outer(spark, folder):
    long = retail.economic_long(spark, folder)
    tables = [long.where(F.col("series_id") == c).select("date", F.col("value").alias(c)) for c in INDICATOR_NAMES]
    return joins.outer_chain(tables)


@query(
    "j06_map_aggregate_back",
    with_panel() + f"SELECT {KEY}, {f('AVG(demand) OVER (PARTITION BY item_id)', 'item_mean')} FROM panel",
)
def map_back(spark, folder):
    base = retail.panel(spark, folder).select(*KEYS, "demand")
    means = base.groupBy("item_id").agg(F.avg("demand").alias("item_mean"))
    return joins.attach(base, means, ["item_id"], spread_by=["date", "store_id"]).drop("demand")


@query(
    "j07_seasonal_strength",
    with_panel(MONTHLY) + f"""SELECT {cols('p.store_id', 'p.item_id', d('p.date', 'date'), f('month_mean / nullif(item_mean, 0)', 'seasonal_strength'))}
      FROM panel p JOIN monthly m ON m.item_id = p.item_id AND m.m = month(p.date) JOIN overall o ON o.item_id = p.item_id""",
)
def seasonal(spark, folder):
    return add_seasonal_strength(retail.panel(spark, folder)).select(*KEYS, "seasonal_strength")


@query(
    "j08_item_age",
    with_panel() + f"""SELECT {KEY}, {i('date - COALESCE(MIN(CASE WHEN demand > 0 THEN date END) OVER (PARTITION BY item_id), date)', 'item_age_days')} FROM panel""",
)
def item_age(spark, folder):
    return add_item_age(retail.panel(spark, folder)).select(*KEYS, "item_age_days")


@query(
    "a15_store_performance",
    with_panel() + f"SELECT {KEY}, {f('demand / (AVG(demand) OVER (PARTITION BY item_id, date) + 1e-8)', 'store_performance')} FROM panel",
)
def performance(spark, folder):
    return add_store_performance(retail.panel(spark, folder)).select(*KEYS, "store_performance")


KNOWN = "known AS (SELECT item_id FROM panel WHERE day_num <= 2 AND demand > 0)"


def known_items(frame):
    return frame.where((F.col("day_num") <= 2) & (F.col("demand") > 0))


@query(
    "j10_semi_join",
    with_panel(KNOWN) + f"SELECT {KEY}, {i('demand')} FROM panel WHERE item_id IN (SELECT item_id FROM known)",
)
def semi(spark, folder):
    frame = retail.panel(spark, folder)
    return joins.keep_known(frame, known_items(frame), "item_id", ["store_id", "date"]).select(*KEYS, "demand")


@query(
    "j11_unseen_values",
    with_panel(KNOWN) + "SELECT DISTINCT item_id FROM panel WHERE item_id NOT IN (SELECT item_id FROM known)",
)
def unseen(spark, folder):
    frame = retail.panel(spark, folder)
    return joins.unseen_values(frame, known_items(frame), "item_id")


@query("j12_days_since_start", with_panel() + f"SELECT {KEY}, {i('date - MIN(date) OVER ()', 'days_since_start')} FROM panel")
def since_start(spark, folder):
    frame = retail.panel(spark, folder)
    start = frame.agg(F.min("date")).scalar()
    return frame.select(*KEYS, F.datediff("date", start).alias("days_since_start"))


def wide_months(spark, folder):
    """The whole panel as a wide table: one row per series and month, one column per day of month."""
    frame = retail.panel(spark, folder).withColumns(
        {"id": F.concat_ws("_", "id", F.date_format("date", "yyyyMM")), "label": F.concat(F.lit("d_"), F.dayofmonth("date"))}
    )
    ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    labels = [f"d_{n}" for n in range(1, 32)]
    return frame.groupBy(*ids).pivot("label", labels).agg(F.sum("demand").cast("int"))


MELTED = with_panel() + f"""SELECT id || '_' || strftime(date, '%Y%m') AS id, item_id, dept_id, cat_id, store_id, state_id,
  'd_' || day(date) AS d, {i('demand')}, {i('day(date)', 'day_num')} FROM panel"""


@query("r01_melt", MELTED)
def melt(spark, folder):
    """Days a month does not have are empty cells, as days before a launch would be."""
    return reshape.melt(wide_months(spark, folder)).where(F.col("demand").isNotNull())


@query("r03_project_rename", "WITH " + ECONOMIC + f" SELECT {d('date')}, {f('value', 'UNRATE')} FROM economic_long WHERE series_id = 'UNRATE'")
def project(spark, folder):
    rows = retail.economic_long(spark, folder).where(F.col("series_id") == "UNRATE")
    return rows.select("date", "value").withColumnRenamed("value", "UNRATE")


@query("r04_drop_columns", with_panel() + f"SELECT {cols('id', 'item_id', 'store_id', 'state_id', i('demand'))} FROM panel")
def drop(spark, folder):
    return retail.panel(spark, folder).drop("dept_id", "cat_id", "d", "day_num", "date")


@query(
    "r05_trailing_days",
    with_panel() + f"SELECT {KEY}, {i('demand')} FROM panel WHERE day_num >= (SELECT MAX(day_num) FROM panel) - 100",
)
def trailing(spark, folder):
    return ordering.trailing_days(retail.panel(spark, folder), 101).select(*KEYS, "demand")


@query(
    "r06_first_items",
    with_panel() + f"""SELECT {KEY}, {i('demand')} FROM panel WHERE item_id IN (
      SELECT item_id FROM panel WHERE demand > 0 GROUP BY item_id ORDER BY MIN(date), item_id LIMIT 10)""",
)
def first_items(spark, folder):
    frame = retail.panel(spark, folder).select(*KEYS, "demand")
    chosen = ordering.first_items(frame.where(F.col("demand") > 0), 10)
    return joins.attach(frame, chosen, ["item_id"], how="left_semi", spread_by=["store_id", "date"])


@query("r07_nonzero_rows", with_panel() + f"SELECT {KEY}, {i('demand')} FROM panel WHERE demand > 0")
def nonzero(spark, folder):
    return retail.panel(spark, folder).select(*KEYS, "demand").where(F.col("demand") > 0)


@query("r08_drop_null_prices", with_priced() + f"SELECT {KEY}, {f('raw_price', 'sell_price')} FROM priced WHERE raw_price IS NOT NULL")
def drop_nulls(spark, folder):
    dated = joins.join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    return joins.join_prices(dated, retail.prices(spark, folder)).dropna(subset=["sell_price"]).select(*KEYS, "sell_price")


@query("r09_sample_rows")
def sample(spark, folder):
    return ordering.sample_rows(retail.panel(spark, folder).select(*KEYS, "demand"), 1000)


@query(
    "r10_date_range",
    with_panel() + f"SELECT {KEY}, {i('demand')} FROM panel WHERE date BETWEEN DATE '1999-03-01' AND DATE '1999-06-30'",
)
def date_range(spark, folder):
    return retail.panel(spark, folder).where(F.col("date").between("1999-03-01", "1999-06-30")).select(*KEYS, "demand")


@query(
    "r11_r13_model_matrix",
    with_priced() + f"SELECT {KEY}, {f('day_num')}, {f('CAST(sell_price AS FLOAT)', 'sell_price', 2)} FROM priced",
    digits=2,
)
def matrix(spark, folder):
    df = priced(spark, folder)
    columns = prepare.feature_columns(df)
    return prepare.as_float(prepare.numeric_matrix(df, columns, keep=KEYS), columns)


@query(
    "r12_align_columns",
    with_panel() + f"SELECT {KEY}, {f('0.0', 'absent')}, {i('day_num')} FROM panel",
)
def align(spark, folder):
    return prepare.align_columns(retail.panel(spark, folder), ["absent", "day_num"], keep=KEYS)


@query(
    "r14_text_to_numbers",
    with_panel() + f"""SELECT p.id, {d('p.date', 'date')}, {f('p.day_num', 'numeric_text')}, {f('c.code', 'cat_id')} FROM panel p
      JOIN (SELECT cat_id, row_number() OVER (ORDER BY cat_id) - 1 AS code FROM (SELECT DISTINCT cat_id FROM panel)) c ON c.cat_id = p.cat_id""",
)
def text_to_numbers(spark, folder):
    df = retail.panel(spark, folder).withColumn("numeric_text", F.col("day_num").cast("string"))
    return prepare.numeric_matrix(df, ["numeric_text", "cat_id"], keep=["id", "date"], spread_by=["id", "date"])


@query("r15_features_and_target", with_priced() + f"SELECT {KEY}, {i('demand', 'label')}, {i('day_num')}, {f('sell_price')} FROM priced")
def separate(spark, folder):
    df = priced(spark, folder)
    features = [c for c in prepare.feature_columns(df) if c != "demand"]
    return df.select(*KEYS, F.col("demand").alias("label"), *features)
