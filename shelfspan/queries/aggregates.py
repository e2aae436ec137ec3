"""Exploration aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.operators import encode, ordering, price, profile, splits
from shelfspan.operators.business import first_sale_dates, monthly_strength
from shelfspan.plans import retail
from shelfspan.queries.base import WEATHER, cols, d, f, i, query, with_panel, with_priced
from shelfspan.queries.windows import KEYS, priced



def panel(spark, folder):
    return retail.panel(spark, folder)


@query("a01_daily_totals", with_panel() + f"SELECT {cols(d('date'), i('SUM(demand)', 'demand'))} FROM panel GROUP BY panel.date")
def daily(spark, folder):
    return profile.daily_totals(panel(spark, folder))


def _mean_daily(part: str, name: str) -> str:
    return with_panel() + f"""SELECT {cols(i(part, name), f('AVG(total)', 'avg_daily'))}
      FROM (SELECT date, SUM(demand) AS total FROM panel GROUP BY date) GROUP BY 1"""


@query("a02_mean_daily_by_month", _mean_daily("month(date)", "month"))
def by_month(spark, folder):
    return profile.mean_daily_total(panel(spark, folder), F.month("date"), "month")


@query("a02_mean_daily_by_weekday", _mean_daily("isodow(date) - 1", "dayofweek"))
def by_weekday(spark, folder):
    return profile.mean_daily_total(panel(spark, folder), F.weekday("date"), "dayofweek")


@query(
    "a03_category_profile",
    with_panel() + f"""SELECT {cols('cat_id', f('SUM(demand)', 'total_sales', 2), f('AVG(demand)', 'avg_sales', 2),
      f('STDDEV_SAMP(demand)', 'std_sales', 2), i('COUNT(demand)', 'records'))} FROM panel GROUP BY cat_id""",
)
def category(spark, folder):
    return profile.category_profile(panel(spark, folder)).withColumn("total_sales", F.col("total_sales").cast("double"))


@query("a04_zero_share", with_panel() + f"SELECT {cols('cat_id', f('AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) * 100', 'zero_pct'))} FROM panel GROUP BY cat_id")
def zeros(spark, folder):
    return profile.zero_share(panel(spark, folder))


@query(
    "a05_price_stats",
    with_priced() + f"""SELECT {cols('cat_id', f('AVG(sell_price)', 'mean', 4), f('STDDEV_SAMP(sell_price)', 'std', 4),
      f('MIN(sell_price)', 'min', 4), f('MAX(sell_price)', 'max', 4), i('COUNT(sell_price)', 'count'))} FROM priced
      WHERE sell_price IS NOT NULL GROUP BY cat_id""",
    digits=4,
)
def prices(spark, folder):
    return profile.price_stats(priced(spark, folder))


@query(
    "a06_price_demand_correlation",
    with_priced() + f"SELECT {cols('cat_id', f('CORR(sell_price, demand)', 'price_demand_corr'))} FROM priced WHERE sell_price IS NOT NULL GROUP BY cat_id",
)
def correlation(spark, folder):
    return profile.price_demand_correlation(priced(spark, folder))


DESCRIBED = cols(
    i("COUNT({0})", "count"), f("AVG({0})", "mean", 4), f("STDDEV_SAMP({0})", "std", 4), f("MIN({0})", "min", 4),
    f("MAX({0})", "max", 4), f("quantile_cont({0}, 0.25)", "q25", 4), f("quantile_cont({0}, 0.5)", "q50", 4),
    f("quantile_cont({0}, 0.75)", "q75", 4),
)


@query("a07_describe_demand", with_panel() + f"SELECT {DESCRIBED.format('CAST(demand AS DOUBLE)')} FROM panel", digits=4)
def describe_demand(spark, folder):
    return profile.describe(panel(spark, folder).withColumn("demand", F.col("demand").cast("double")), "demand")


@query("a07_describe_price", with_priced() + f"SELECT {DESCRIBED.format('sell_price')} FROM prices", digits=4)
def describe_price(spark, folder):
    return profile.describe(retail.prices(spark, folder), "sell_price")


@query(
    "a08_distinct_counts",
    with_panel() + f"SELECT {cols(*[i(f'COUNT(DISTINCT {c})', f'n_{c}') for c in ('item_id', 'dept_id', 'cat_id', 'store_id', 'state_id', 'd')])} FROM panel",
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(panel(spark, folder), ["item_id", "dept_id", "cat_id", "store_id", "state_id", "d"])


@query("a08_u02_distinct_values", with_panel() + "SELECT DISTINCT cat_id, state_id FROM panel")
def distinct_values(spark, folder):
    return panel(spark, folder).select("cat_id", "state_id").distinct()


SUMMARY = f"""SELECT {cols(
    i('COUNT(DISTINCT item_id)', 'total_items'), i('COUNT(DISTINCT store_id)', 'total_stores'), i('COUNT(DISTINCT d)', 'total_days'),
    i('COUNT(*)', 'total_records'), f('AVG(demand)', 'avg_daily_demand'),
    f('AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) * 100', 'zero_sales_pct'), i('MAX(demand)', 'max_daily_demand'),
    f('STDDEV_SAMP(demand)', 'std_demand'), i('MAX(price_records)', 'price_records'), f('MAX(min_price)', 'min_price'),
    f('MAX(max_price)', 'max_price'))}
  FROM panel CROSS JOIN (SELECT COUNT(*) AS price_records, MIN(sell_price) AS min_price, MAX(sell_price) AS max_price FROM prices)"""


@query("a09_table_summary", with_priced() + SUMMARY)
def summary(spark, folder):
    return profile.summary(panel(spark, folder), retail.prices(spark, folder))


CALENDAR_COLUMNS = ("date", "wm_yr_wk", "weekday", "event_name_1", "event_type_1", "event_name_2", "event_type_2", "snap_CA")


@query(
    "a10_null_counts",
    with_panel() + f"SELECT {cols(*[i(f'COUNT(*) - COUNT({c})', c) for c in CALENDAR_COLUMNS])} FROM calendar",
)
def nulls(spark, folder):
    return profile.null_counts(retail.calendar(spark, folder).select(*CALENDAR_COLUMNS))


RAW = "raw_prices AS (SELECT id, demand, raw_price FROM priced)"


@query("a10_null_counts_price_join", with_priced(RAW) + f"SELECT {cols(*[i(f'COUNT(*) - COUNT({c})', c) for c in ('id', 'demand', 'raw_price')])} FROM raw_prices")
def panel_nulls(spark, folder):
    return profile.null_counts(raw_price_panel(spark, folder))


def raw_price_panel(spark, folder):
    from shelfspan.operators.joins import join_calendar, join_prices

    dated = join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    joined = join_prices(dated, retail.prices(spark, folder))
    return joined.select("id", "demand", F.col("sell_price").alias("raw_price"))


COMPLETE = "shares AS (SELECT " + ", ".join(
    f"COUNT({c}) * 100.0 / COUNT(*) AS {c}" for c in CALENDAR_COLUMNS
) + " FROM calendar)"


@query(
    "a11_low_completeness",
    with_panel(COMPLETE) + f"SELECT \"column\", {f('completeness')} FROM shares UNPIVOT (completeness FOR \"column\" IN ({', '.join(CALENDAR_COLUMNS)})) WHERE completeness < 90",
)
def completeness(spark, folder):
    return profile.completeness(retail.calendar(spark, folder).select(*CALENDAR_COLUMNS), below=90)


@query("a12_first_sale_dates", with_panel() + f"SELECT {cols('item_id', d('MIN(date)', 'first_sale'))} FROM panel WHERE demand > 0 GROUP BY item_id")
def first_sales(spark, folder):
    return first_sale_dates(panel(spark, folder))


MONTHLY = """
monthly AS (SELECT item_id, month(date) AS m, AVG(demand) AS month_mean FROM panel GROUP BY 1, 2),
overall AS (SELECT item_id, AVG(month_mean) AS item_mean FROM monthly GROUP BY 1)"""


@query(
    "a13_monthly_and_item_means",
    with_panel(MONTHLY) + f"""SELECT {cols('item_id', i('m', 'month'), f('month_mean'), f('item_mean'),
      f('month_mean / nullif(item_mean, 0)', 'seasonal_strength'))} FROM monthly JOIN overall USING (item_id)""",
)
def monthly(spark, folder):
    return monthly_strength(panel(spark, folder)).withColumnRenamed("_m", "month")


@query(
    "a14_category_competition",
    with_panel() + f"""SELECT {cols('p.store_id', 'p.item_id', d('p.date', 'date'), i('n', 'category_competition'))} FROM panel p
      JOIN (SELECT store_id, cat_id, date, COUNT(DISTINCT item_id) AS n FROM panel GROUP BY 1, 2, 3) c
        ON c.store_id = p.store_id AND c.cat_id = p.cat_id AND c.date = p.date""",
)
def competition(spark, folder):
    from shelfspan.operators.business import add_competition

    return add_competition(panel(spark, folder)).select(*KEYS, "category_competition")


RATIOS = {
    "price_relative_to_category": ("cat_id", "date"), "price_relative_to_store": ("store_id", "date"),
    "price_vs_item_avg": ("item_id",), "price_vs_cat_avg": ("cat_id",),
}


@query(
    "a15_price_group_ratios",
    with_priced() + f"""SELECT {cols('store_id', 'item_id', d('date'),
      *[f(f"sell_price / AVG(sell_price) OVER (PARTITION BY {', '.join(by)})", name) for name, by in RATIOS.items()])} FROM priced""",
)
def ratios(spark, folder):
    from shelfspan.session import settle

    df = settle(priced(spark, folder), "priced")
    for name, by in RATIOS.items():
        df = price.add_group_ratio(df, "sell_price", by, name)
    return df.select(*KEYS, *RATIOS)


ENCODED = ("item_id", "dept_id", "cat_id", "store_id", "state_id")


@query(
    "a16_target_encoding",
    with_panel() + f"""SELECT {cols('store_id', 'item_id', d('date'), *[
      x for c in ENCODED for x in (
        f(f'AVG(demand) OVER (PARTITION BY {c})', f'{c}_target_mean'),
        f(f'COALESCE(STDDEV_SAMP(demand) OVER (PARTITION BY {c}), 0)', f'{c}_target_std'),
        i(f'COUNT(demand) OVER (PARTITION BY {c})', f'{c}_target_count'))])} FROM panel""",
)
def target_encoding(spark, folder):
    full = encode.add_target_encoding(panel(spark, folder), ENCODED)
    return full.select(*KEYS, *[f"{c}_target_{x}" for c in ENCODED for x in ("mean", "std", "count")])


@query(
    "a16_shifted_target",
    with_panel() + f"""SELECT {cols('store_id', 'item_id', d('date'), *[
      x for c in ('cat_id', 'store_id') for x in (
        f(f'AVG(demand) OVER (PARTITION BY {c}) + 100000000', f'{c}_target_mean', 4),
        f(f'STDDEV_SAMP(demand) OVER (PARTITION BY {c})', f'{c}_target_std', 4))])} FROM panel""",
    digits=4,
)
def shifted_target(spark, folder):
    """A target far from zero keeps the digits of its deviation."""
    far = panel(spark, folder).withColumn("demand", F.col("demand") + 100_000_000)
    full = encode.add_target_encoding(far, ("cat_id", "store_id"))
    return full.select(*KEYS, *[f"{c}_target_{x}" for c in ("cat_id", "store_id") for x in ("mean", "std")])


@query(
    "a16_target_statistics",
    with_panel() + f"""SELECT {cols('item_id', f('AVG(demand)', 'item_id_target_mean'), f('STDDEV_SAMP(demand)', 'item_id_target_std'),
      i('COUNT(demand)', 'item_id_target_count'))} FROM panel GROUP BY item_id""",
)
def target_statistics(spark, folder):
    return encode.target_statistics(panel(spark, folder), "item_id")


@query(
    "a17_precipitation_quantile",
    "WITH " + WEATHER + f" SELECT state_id, {f('quantile_cont(precip, 0.75)', 'p75')} FROM weather GROUP BY state_id",
)
def rain_quantile(spark, folder):
    return ordering.percentile_columns(retail.weather(spark, folder), "precip", {"p75": 0.75}, ["state_id"])


WEATHER_NUMBERS = ("tempmax", "tempmin", "temp", "humidity", "precip", "windspeed")


@query(
    "a18_column_medians",
    "WITH " + WEATHER + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {f(f'quantile_cont({c}, 0.5)', 'median')} FROM weather" for c in WEATHER_NUMBERS
    ),
)
def medians(spark, folder):
    from shelfspan.operators.prepare import fit_medians

    return fit_medians(retail.weather(spark, folder), WEATHER_NUMBERS)


SPLIT = """
labeled AS (SELECT *, CASE WHEN (MAX(date) OVER ()) - date < 28 THEN 'test'
                           WHEN (MAX(date) OVER ()) - date < 56 THEN 'valid' ELSE 'train' END AS split FROM panel)"""


@query(
    "a19_split_ranges",
    with_panel(SPLIT) + f"SELECT {cols('split', d('MIN(date)', 'first_date'), d('MAX(date)', 'last_date'), i('COUNT(*)', 'n_rows'))} FROM labeled GROUP BY split",
)
def split_ranges(spark, folder):
    return profile.split_ranges(splits.split_by_last_days(panel(spark, folder)))


@query(
    "a20_duplicate_keys",
    f"SELECT {cols(i('l_orderkey'), i('l_linenumber'), i('COUNT(*)', 'n'))} FROM lineitem GROUP BY lineitem.l_orderkey, lineitem.l_linenumber HAVING COUNT(*) > 1",
)
def duplicates(spark, folder):
    return profile.duplicate_keys(retail.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a21_demand_histogram",
    with_panel() + f"""SELECT {cols(i('bin'), f('lo + bin * w', 'left_edge'), i('n'))} FROM (
      SELECT least(floor((demand - lo) / w), 49) AS bin, lo, w, COUNT(*) AS n
      FROM panel CROSS JOIN (SELECT MIN(demand) AS lo, (MAX(demand) - MIN(demand)) / 50.0::DOUBLE AS w FROM panel) GROUP BY 1, 2, 3)""",
)
def demand_histogram(spark, folder):
    return profile.histogram(panel(spark, folder), "demand", 50)


@query(
    "a21_nonzero_density_by_category",
    with_panel() + f"""SELECT {cols('cat_id', i('bin'), f('lo + bin * w', 'left_edge'), i('n'), f('n / (total * w)', 'density'))} FROM (
      SELECT p.cat_id, least(floor((demand - lo) / w), 29) AS bin, lo, w, total, COUNT(*) AS n
      FROM panel p JOIN (SELECT cat_id, MIN(demand) AS lo, (MAX(demand) - MIN(demand)) / 30.0::DOUBLE AS w, COUNT(*) AS total
                         FROM panel WHERE demand > 0 GROUP BY cat_id) r ON r.cat_id = p.cat_id
      WHERE demand > 0 GROUP BY 1, 2, 3, 4, 5)""",
)
def density(spark, folder):
    sold = panel(spark, folder).where(F.col("demand") > 0)
    return profile.histogram(sold, "demand", 30, ["cat_id"], density=True)


@query("t01_sorted_panel", with_panel() + f"SELECT {cols('id', d('date'), i('demand'))} FROM panel ORDER BY id, panel.date")
def sorted_panel(spark, folder):
    return panel(spark, folder).select("id", "date", "demand").orderBy("id", "date")


@query(
    "t02_date_from_end",
    "SELECT strftime(day, '%Y-%m-%d') AS date FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem) ORDER BY day DESC LIMIT 1 OFFSET 27",
)
def date_from_end(spark, folder):
    days = retail.table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return ordering.nth_last_date(days, 28)


@query(
    "t03_top_items",
    with_panel() + f"SELECT {cols('item_id', i('SUM(demand)', 'total'))} FROM panel GROUP BY item_id ORDER BY total DESC, item_id LIMIT 15",
)
def top_items(spark, folder):
    totals = panel(spark, folder).groupBy("item_id").agg(F.sum("demand").alias("total"))
    return ordering.top_k(totals, "total", 15, "item_id")


@query(
    "u01_union_of_states",
    "WITH " + WEATHER + f" SELECT {cols('state_id', d('date'), f('temp'), f('precip'))} FROM weather",
)
def union(spark, folder):
    from shelfspan.operators.panel import union_tables

    weather = retail.weather(spark, folder).select("state_id", "date", "temp", "precip")
    return union_tables([weather.where(F.col("state_id") == s) for s in ("CA", "TX", "WI", "none")])
