"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.functions import scalar
from shelfspan.operators import external, interactions
from shelfspan.operators.demand import add_lags
from shelfspan.operators.price import add_discounts, add_price_bin, add_relative_change, change
from shelfspan.plans import retail
from shelfspan.queries.base import KEY, OVER, WEATHER, cols, d, f, i, query, s, with_panel, with_priced
from shelfspan.queries.windows import KEYS, PREVIOUS, priced
from shelfspan.session import settle

PARTS = {
    "year": "year(date)", "month": "month(date)", "day": "day(date)", "dayofweek": "isodow(date) - 1",
    "dayofyear": "dayofyear(date)", "week": "weekofyear(date)", "quarter": "quarter(date)",
}


def order_days(spark, folder):
    """Every order with its date: a table that grows with the data."""
    return retail.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))


def orders_sql(*parts: str) -> str:
    return f"""WITH dated AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders)
      SELECT {cols(i('o_orderkey'), *parts)} FROM dated"""


@query("h01_date_parts", orders_sql(d("date"), *[i(x, n) for n, x in PARTS.items()]))
def parts(spark, folder):
    return order_days(spark, folder).withColumns(scalar.date_parts())


def edge(unit: str, kind: str) -> str:
    first = f"CAST(date_trunc('{unit}', date) AS DATE)"
    if kind == "start":
        return f"CASE WHEN date = {first} THEN 1 ELSE 0 END"
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return f"CASE WHEN date + 1 = CAST({first} + INTERVAL {months} MONTH AS DATE) THEN 1 ELSE 0 END"


@query("h02_period_edges", orders_sql(*[i(edge(u, k), f"is_{u}_{k}") for u in ("month", "quarter", "year") for k in ("start", "end")]))
def edges(spark, folder):
    return order_days(spark, folder).withColumns(scalar.period_edges()).drop("date")


@query(
    "h03_h04_near_edges_and_weekend",
    orders_sql(
        i("CASE WHEN day(date) <= 3 THEN 1 ELSE 0 END", "is_month_start"), i("CASE WHEN day(date) >= 28 THEN 1 ELSE 0 END", "is_month_end"),
        i("CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END", "is_weekend"),
    ),
)
def near_edges(spark, folder):
    added = {**scalar.near_month_edges(F.dayofmonth("date")), "is_weekend": scalar.weekend()}
    return order_days(spark, folder).withColumns(added).drop("date")


@query(
    "h05_date_parsing_and_arithmetic",
    orders_sql(d("date"), d("date_trunc('month', date)", "month_start"), d("date - 28", "four_weeks_before"),
               i("date - DATE '1995-01-01'", "days_since_1995")),
)
def arithmetic(spark, folder):
    text = order_days(spark, folder).withColumn("date", F.to_date(F.date_format("date", "yyyy-MM-dd")))
    return text.withColumns(
        {
            "month_start": scalar.month_period(), "four_weeks_before": F.date_sub("date", 28),
            "days_since_1995": F.datediff("date", F.to_date(F.lit("1995-01-01"))),
        }
    )


def wave(expr: str, period: str, names: tuple[str, str]) -> list[str]:
    return [f(f"{fn}(2 * pi() * ({expr}) / {period})", n) for fn, n in zip(("sin", "cos"), names)]


LIVE = {"month": "12", "dayofweek": "7", "day": "31"}
VARIANT = {"dayofyear": "365.25", "week": "52", "month": "12", "dayofweek": "7"}


@query("h06_cyclic_encoding", orders_sql(*[x for n, p in LIVE.items() for x in wave(PARTS[n], p, (f"{n}_sin", f"{n}_cos"))]))
def cyclic(spark, folder):
    df = order_days(spark, folder).withColumns(scalar.date_parts())
    added = {}
    for name, period in LIVE.items():
        added[f"{name}_sin"], added[f"{name}_cos"] = scalar.cyclic(F.col(name), float(period))
    return df.withColumns(added).select("o_orderkey", *added)


@query("h07_cyclic_variants", orders_sql(*[x for n, p in VARIANT.items() for x in wave(PARTS[n], p, (f"sin_{n}", f"cos_{n}"))]))
def cyclic_variants(spark, folder):
    df = order_days(spark, folder).withColumns(scalar.date_parts())
    added = {}
    for name, period in VARIANT.items():
        added[f"sin_{name}"], added[f"cos_{name}"] = scalar.cyclic(F.col(name), float(period))
    return df.withColumns(added).select("o_orderkey", *added)


@query("h08_relative_position", orders_sql(f("dayofyear(date) / 365.25", "relative_day_of_year"), i("date - MIN(date) OVER ()", "days_since_start")))
def position(spark, folder):
    df = order_days(spark, folder)
    start = df.agg(F.min("date")).scalar()
    return df.select("o_orderkey", (F.dayofyear("date") / 365.25).alias("relative_day_of_year"), F.datediff("date", start).alias("days_since_start"))


HOLIDAYS = {
    "is_christmas_week": "month(date) = 12 AND day(date) >= 22",
    "is_thanksgiving_week": "month(date) = 11 AND day(date) >= 22 AND day(date) <= 28",
    "is_new_year_week": "month(date) = 1 AND day(date) <= 7",
    "is_memorial_day": "month(date) = 5 AND isodow(date) = 1 AND day(date) >= 25",
    "is_labor_day": "month(date) = 9 AND isodow(date) = 1 AND day(date) <= 7",
}


def holidays_sql() -> list[str]:
    return [i(f"CASE WHEN {x} THEN 1 ELSE 0 END", n) for n, x in HOLIDAYS.items()]


@query("h09_holiday_windows", orders_sql(*holidays_sql()))
def holidays(spark, folder):
    df = order_days(spark, folder).withColumns(scalar.date_parts()).withColumns(scalar.holiday_windows())
    return df.select("o_orderkey", *HOLIDAYS)


EVENT_SQL = {
    "has_event_1": "event_name_1 IS NOT NULL", "has_event_2": "event_name_2 IS NOT NULL",
    "has_any_event": "event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL",
}


def flags(parts: dict[str, str]) -> list[str]:
    return [i(f"CASE WHEN {x} THEN 1 ELSE 0 END", n) for n, x in parts.items()]


@query("h10_event_flags", with_panel() + f"SELECT {cols(d('date'), *flags(EVENT_SQL))} FROM calendar")
def events(spark, folder):
    return retail.calendar(spark, folder).withColumns(scalar.event_flags()).select("date", *EVENT_SQL)


EXISTS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")


@query(
    "h11_event_presence",
    with_panel() + f"SELECT {cols(d('date'), *flags({f'{c}_encoded_exists': f'{c} IS NOT NULL' for c in EXISTS}))} FROM calendar",
)
def presence(spark, folder):
    return retail.calendar(spark, folder).select("date", *[scalar.flag(F.col(c).isNotNull()).alias(f"{c}_encoded_exists") for c in EXISTS])


@query(
    "h12_snap_total",
    with_panel() + f"""SELECT {cols(d('date'), i('snap_CA + snap_TX + snap_WI', 'snap_total'),
      i('CASE WHEN snap_CA + snap_TX + snap_WI > 0 THEN 1 ELSE 0 END', 'has_snap'))} FROM calendar""",
)
def snap(spark, folder):
    df = retail.calendar(spark, folder)
    return df.select("date", *[c.alias(n) for n, c in scalar.snap_flags(["snap_CA", "snap_TX", "snap_WI"]).items()])


@query(
    "h13_math",
    f"""SELECT {cols(i('o_orderkey'), f('sqrt(o_totalprice)', 'root', 4), f('abs(o_totalprice - 100000)', 'distance', 4),
      f('ln(1 + o_totalprice)', 'log', 4), f('greatest(o_totalprice - 100000, 0)', 'above', 4), f('least(o_totalprice / 100000, 1)', 'share', 4))}
      FROM orders""",
    digits=4,
)
def math(spark, folder):
    price = F.col("o_totalprice")
    return retail.table(spark, folder, "orders").select(
        "o_orderkey", F.sqrt(price).alias("root"), F.abs(price - 100000).alias("distance"), F.log1p(price).alias("log"),
        F.greatest(price - 100000, F.lit(0.0)).alias("above"), F.least(price / 100000, F.lit(1.0)).alias("share"),
    )


@query(
    "h14_guarded_division",
    f"""SELECT {cols(i('l_orderkey'), i('l_partkey'), i('l_suppkey'), i('l_linenumber'),
      f('l_extendedprice / nullif(l_discount, 0)', 'per_discount', 2), f('l_quantity / (l_tax + 1e-8)', 'per_tax', 2))} FROM lineitem""",
    digits=2,
)
def guarded(spark, folder):
    return retail.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        scalar.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("per_discount"),
        (F.col("l_quantity") / (F.col("l_tax") + 1e-8)).alias("per_tax"),
    )


@query(
    "h15_conditionals",
    with_priced() + f"""SELECT {KEY}, {cols(f('COALESCE(raw_price, 0)', 'price_or_zero'),
      i('CASE WHEN demand > 0 THEN 1 ELSE 0 END', 'sold'), i('nullif(demand, 0)', 'known_demand'))} FROM priced""",
)
def conditionals(spark, folder):
    from shelfspan.operators.joins import join_calendar, join_prices

    dated = join_calendar(retail.sales(spark, folder), retail.calendar(spark, folder).select("d", "date", "wm_yr_wk"))
    df = join_prices(dated, retail.prices(spark, folder))
    return df.select(
        *KEYS, F.coalesce("sell_price", F.lit(0.0)).alias("price_or_zero"), scalar.flag(F.col("demand") > 0).alias("sold"),
        F.nullif("demand", F.lit(0)).alias("known_demand"),
    )


@query(
    "h16_discounts",
    with_priced() + f"""SELECT {KEY}, {i(f'CASE WHEN delta < -0.01 THEN 1 ELSE 0 END', 'is_discount')},
      {f('CASE WHEN delta < 0 THEN abs(delta) ELSE 0 END', 'discount_magnitude')}
      FROM (SELECT *, sell_price - {PREVIOUS} AS delta FROM priced)""",
)
def discounts(spark, folder):
    df = priced(spark, folder).withColumn("price_change", change("sell_price"))
    return add_discounts(df).select(*KEYS, "is_discount", "discount_magnitude")


@query(
    "h17_strings",
    with_panel() + f"SELECT {cols('id', 'd', i(chr(39).join(['regexp_extract(d, ', '([0-9]+)', ', 1)']), 'n'), s(chr(39).join(['state_id || ', '_', ' || cat_id']), 'state_cat'), i(chr(39).join(['CASE WHEN starts_with(item_id, ', 'Brand#1', ') THEN 1 ELSE 0 END']), 'is_one'))} FROM panel",
)
def strings(spark, folder):
    return retail.sales(spark, folder).select(
        "id", "d", F.regexp_extract("d", "([0-9]+)", 1).cast("int").alias("n"),
        scalar.joined_text("state_id", "cat_id").alias("state_cat"), scalar.flag(F.startswith("item_id", F.lit("Brand#1"))).alias("is_one"),
    )


def weather_sql(*parts: str, extra: str = "", source: str = "weather") -> str:
    return "WITH " + WEATHER + extra + f" SELECT {cols('state_id', d('date'), *parts)} FROM {source}"


CATEGORY = "CASE WHEN temp <= 32 THEN 'freezing' WHEN temp <= 50 THEN 'cold' WHEN temp <= 70 THEN 'mild' WHEN temp <= 85 THEN 'warm' ELSE 'hot' END"


@query("h18_temperature_category", weather_sql(f("temp"), s(CATEGORY, "temp_category"), f("tempmax - tempmin", "temp_range"), i("CASE WHEN precip > 0 THEN 1 ELSE 0 END", "is_rainy")))
def temperature(spark, folder):
    return external.derive_weather(retail.weather(spark, folder)).select("state_id", "date", "temp", "temp_category", "temp_range", "is_rainy")


STATS = """, stats AS (SELECT MIN(temp) AS t0, (MAX(temp) - MIN(temp)) AS tw, MIN(humidity) AS h0, (MAX(humidity) - MIN(humidity)) AS hw,
  quantile_cont(precip, 0.75) AS p75 FROM weather),
 months AS (SELECT month(date) AS m, AVG(temp) AS mt FROM weather GROUP BY 1),
 enriched AS (SELECT * FROM weather CROSS JOIN stats JOIN months ON m = month(date))"""


def _bins(value: str, low: str, width: str, labels: tuple[str, ...]) -> str:
    n = len(labels)
    arms = " ".join(f"WHEN {value} <= {low} + {width} * {k} / {n} THEN '{x}'" for k, x in enumerate(labels[:-1], 1))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


@query(
    "h19_h21_weather_features",
    weather_sql(
        s(_bins("temp", "t0", "tw", external.TEMPERATURE_BINS), "temp_binned"), s(_bins("humidity", "h0", "hw", external.HUMIDITY_BINS), "humidity_binned"),
        f("temp * temp", "temp_squared", 4), f("mt", "temp_seasonal_avg", 4), f("temp - mt", "temp_relative_seasonal", 4),
        i("CASE WHEN precip > 0 THEN 1 ELSE 0 END", "has_precipitation"), i("CASE WHEN precip > p75 THEN 1 ELSE 0 END", "heavy_rain"),
        extra=STATS, source="enriched",
    ),
    digits=4,
)
def weather_features(spark, folder):
    weather = settle(retail.weather(spark, folder), "weather")
    return external.add_weather_features(weather).select(
        "state_id", "date", "temp_binned", "humidity_binned", "temp_squared", "temp_seasonal_avg", "temp_relative_seasonal",
        "has_precipitation", "heavy_rain",
    )


@query(
    "h20_price_quintiles",
    with_priced("edges AS (SELECT quantile_cont(sell_price, [0.2, 0.4, 0.6, 0.8]) AS q FROM priced)")
    + f"""SELECT {KEY}, CASE WHEN sell_price IS NULL THEN NULL WHEN sell_price <= q[1] THEN 'very_low' WHEN sell_price <= q[2] THEN 'low'
      WHEN sell_price <= q[3] THEN 'medium' WHEN sell_price <= q[4] THEN 'high' ELSE 'very_high' END AS price_bin FROM priced CROSS JOIN edges""",
)
def quintiles(spark, folder):
    return add_price_bin(settle(priced(spark, folder), "priced")).select(*KEYS, "price_bin")


LAG7 = f"LAG(demand, 7) OVER ({OVER})"
ANY = "CASE WHEN c.event_name_1 IS NOT NULL OR c.event_name_2 IS NOT NULL THEN 1 ELSE 0 END"


@query(
    "h22_numeric_interactions",
    with_priced(f"""
wide AS (SELECT p.*, {ANY} AS any_event, LAG(p.demand, 7) OVER w AS lag7, p.sell_price / LAG(p.sell_price) OVER w - 1 AS pct
         FROM priced p JOIN calendar c ON c.date = p.date WINDOW w AS (PARTITION BY p.store_id, p.item_id ORDER BY p.date))""")
    + f"""SELECT {KEY}, {cols(f('sell_price * month(date)', 'price_month_interaction'),
      f('sell_price * (CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END)', 'price_weekend_interaction'),
      f('sell_price * any_event', 'price_holiday_interaction'), f('lag7 * sell_price', 'lag7_price_interaction'),
      f('COALESCE(pct, 0) * COALESCE(lag7, 0)', 'price_elasticity_signal'))} FROM wide""",
)
def numeric_interactions(spark, folder):
    from shelfspan.operators.joins import attach

    days = retail.calendar(spark, folder).withColumns({**scalar.event_flags(), "is_weekend": scalar.weekend(), "month": F.month("date")})
    df = attach(priced(spark, folder), days.select("date", "has_any_event", "is_weekend", "month"), ["date"])
    df = add_relative_change(add_lags(df, [7], detail=False), "price_change_pct", "sell_price")
    df = interactions.add_price_interactions(df).withColumn("price_elasticity_signal", interactions.price_elasticity())
    return df.select(
        *KEYS, "price_month_interaction", "price_weekend_interaction", "price_holiday_interaction", "lag7_price_interaction", "price_elasticity_signal"
    )


WEEKEND = "CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END"
COMBOS = {
    "cat_month": "cat_id || '_' || month(date)", "cat_quarter": "cat_id || '_' || quarter(date)",
    "store_month": "store_id || '_' || month(date)", "store_quarter": "store_id || '_' || quarter(date)",
    "weekend_cat": f"({WEEKEND}) || '_' || cat_id", "state_cat_combined": "state_id || '_' || cat_id",
    "store_cat_combined": "store_id || '_' || cat_id", "store_dept_combined": "store_id || '_' || dept_id",
}


@query("h23_categorical_interactions", with_panel() + f"SELECT {KEY}, {cols(*[s(x, n) for n, x in COMBOS.items()])} FROM panel")
def categorical(spark, folder):
    df = retail.panel(spark, folder).withColumns({**scalar.date_parts(), "is_weekend": scalar.weekend()})
    df = interactions.add_combinations(df, {**interactions.SEASON_COMBINATIONS, **interactions.HIERARCHY_COMBINATIONS})
    return df.select(*KEYS, *COMBOS)
