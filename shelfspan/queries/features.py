"""Encodings, splits, preparation and the three feature chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspan.functions.scalar import date_parts
from shelfspan.operators import encode, prepare, splits
from shelfspan.operators.demand import add_lags, add_rolling
from shelfspan.operators.joins import attach, join_weather
from shelfspan.plans import features, retail
from shelfspan.plans.store import append_days, create_store, read_store
from shelfspan.queries.aggregates import MONTHLY, SPLIT
from shelfspan.queries.base import (
    KEY, OVER, WEATHER, cols, d, f, i, query, rows, with_panel, with_priced,
)
from shelfspan.queries.scalars import ANY, COMBOS, HOLIDAYS, LIVE, PARTS, VARIANT, edge, flags, wave
from shelfspan.queries.windows import KEYS, LAST_SALE, priced
from shelfspan.schemas import ACTIVE_WINDOWS, CALENDAR_TEXT, LAGS, MOMENTUM_WINDOWS, PATTERN_WINDOWS, WINDOWS
from shelfspan.session import settle, shared_path

HIERARCHY = ("item_id", "dept_id", "cat_id", "store_id", "state_id")


def codes_cte(name: str, table: str, expr: str) -> str:
    return f"""
code_{name} AS (SELECT v AS v_{name}, row_number() OVER (ORDER BY v) - 1 AS {name}_encoded
               FROM (SELECT DISTINCT {expr} AS v FROM {table}))"""


@query(
    "c01_label_codes",
    with_panel(*[codes_cte(c, "panel", c) for c in HIERARCHY])
    + f"SELECT {KEY}, {cols(*[i(f'{c}_encoded') for c in HIERARCHY])} FROM panel "
    + " ".join(f"JOIN code_{c} ON v_{c} = panel.{c}" for c in HIERARCHY),
)
def label_codes(spark, folder):
    df = retail.panel(spark, folder)
    codes = encode.fit_codes(encode.category_values(df, HIERARCHY))
    coded = encode.apply_codes(df, codes, HIERARCHY, spread_by=["date", "id"])
    return coded.select(*KEYS, *[f"{c}_encoded" for c in HIERARCHY])


@query(
    "c01_calendar_codes",
    with_panel(*[codes_cte(c, "calendar", f"COALESCE({c}, 'None')") for c in CALENDAR_TEXT])
    + f"SELECT {d('date')}, {cols(*[i(f'{c}_encoded') for c in CALENDAR_TEXT])} FROM calendar "
    + " ".join(f"JOIN code_{c} ON v_{c} = COALESCE(calendar.{c}, 'None')" for c in CALENDAR_TEXT),
)
def calendar_codes(spark, folder):
    days = settle(retail.calendar(spark, folder), "calendar")
    codes = encode.fit_codes(encode.category_values(days, CALENDAR_TEXT, "None"))
    coded = encode.apply_codes(days, codes, CALENDAR_TEXT, missing="None")
    return coded.select("date", *[f"{c}_encoded" for c in CALENDAR_TEXT])


@query(
    "c02_codes_with_unknown",
    with_panel(
        "early AS (SELECT * FROM panel WHERE day_num <= 2 AND demand > 0)", codes_cte("item_id", "early", "item_id")
    )
    + f"""SELECT {KEY}, {i('COALESCE(item_id_encoded, (SELECT MAX(item_id_encoded) + 1 FROM code_item_id))', 'item_id_encoded')}
      FROM panel LEFT JOIN code_item_id ON v_item_id = panel.item_id""",
)
def codes_unknown(spark, folder):
    """Codes fitted on what sold in the first two days, applied to every row."""
    df = retail.panel(spark, folder)
    early = df.where((F.col("day_num") <= 2) & (F.col("demand") > 0))
    codes = encode.fit_codes(encode.category_values(early, ["item_id"]))
    return encode.apply_codes_or_unknown(df, codes, ["item_id"], spread_by=["date", "store_id"]).select(*KEYS, "item_id_encoded")


IMPUTED = ("temp", "precip", "windspeed")


@query(
    "c03_median_imputation",
    with_panel(WEATHER, SPLIT, """
joined AS (SELECT l.*, w.temp, w.precip, w.windspeed FROM labeled l LEFT JOIN weather w ON w.date = l.date AND w.state_id = l.state_id),
med AS (SELECT quantile_cont(temp, 0.5) AS m_temp, quantile_cont(precip, 0.5) AS m_precip, quantile_cont(windspeed, 0.5) AS m_windspeed
        FROM joined WHERE split = 'train')""")
    + f"SELECT {KEY}, split, {cols(*[f(f'COALESCE({c}, m_{c}, 0)', c) for c in IMPUTED])} FROM joined CROSS JOIN med",
)
def imputation(spark, folder):
    """Medians fitted on the training dates and applied to all rows."""
    df = join_weather(splits.split_by_last_days(retail.panel(spark, folder)), retail.weather(spark, folder))
    df = settle(df.select(*KEYS, "split", *IMPUTED), "joined")
    medians = prepare.fit_medians(df.where(F.col("split") == "train"), IMPUTED)
    return prepare.impute(df, IMPUTED, medians)


@query(
    "c04_infinite_to_null",
    f"""SELECT {cols(i('l_orderkey'), i('l_partkey'), i('l_suppkey'), i('l_linenumber'), f('l_quantity / nullif(l_discount, 0)', 'per_discount'))} FROM lineitem""",
)
def infinite(spark, folder):
    """Division by a zero discount made infinite on purpose, then made null."""
    from shelfspan.functions.scalar import finite

    value = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_quantity", "l_discount"))
    return retail.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", finite(value).alias("per_discount")
    )


@query("c05_robust_scaling")
def robust(spark, folder):
    from pyspark.ml.functions import vector_to_array

    df = prepare.assemble(retail.panel(spark, folder).select(*KEYS, "demand", "day_num"), ["demand", "day_num"])
    scaled = prepare.robust_scaler().fit(df).transform(df)
    out = vector_to_array("scaled")
    return scaled.select(*KEYS, out[0].alias("demand"), out[1].alias("day_num"))


@query("c06_feature_assembly", with_panel() + f"SELECT {KEY}, {f('demand', 'f0')}, {f('day_num', 'f1')}, 2 AS size FROM panel")
def assembly(spark, folder):
    from pyspark.ml.functions import vector_to_array

    df = prepare.assemble(retail.panel(spark, folder).select(*KEYS, "demand", "day_num"), ["demand", "day_num"])
    out = vector_to_array("features")
    return df.select(*KEYS, out[0].alias("f0"), out[1].alias("f1"), F.size(out).alias("size"))


@query("c08_last_days_split", with_panel(SPLIT) + f"SELECT {KEY}, split FROM labeled")
def last_days(spark, folder):
    return splits.split_by_last_days(retail.panel(spark, folder)).select(*KEYS, "split")


INDEXED = """
indexed AS (SELECT p.*, idx, total FROM panel p JOIN (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS idx, COUNT(*) OVER () AS total FROM (SELECT DISTINCT date FROM panel)) x ON x.date = p.date)"""


@query(
    "c09_distinct_date_split",
    with_panel(INDEXED) + f"SELECT {KEY}, CASE WHEN total - idx <= 28 THEN 'test' WHEN total - idx <= 56 THEN 'valid' ELSE 'train' END AS split FROM indexed",
)
def distinct_dates(spark, folder):
    return splits.split_by_distinct_dates(retail.panel(spark, folder)).select(*KEYS, "split")


def fold_counts(df):
    return df.groupBy("fold", "role").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows"), F.sum("demand").alias("demand")
    )


FOLD_OUT = cols(i("fold"), "role", d("MIN(date)", "first_date"), d("MAX(date)", "last_date"), i("COUNT(*)", "n_rows"), i("SUM(demand)", "demand"))


@query(
    "c10_rolling_origin_folds",
    with_panel(INDEXED, """
placed AS (SELECT date, demand, fold, CASE WHEN idx < total - 28 - fold * ((total - 56) // 3) - 28 THEN 'train'
                 WHEN idx < total - 28 - fold * ((total - 56) // 3) THEN 'valid' END AS role
          FROM indexed CROSS JOIN (SELECT unnest([0, 1, 2]) AS fold))""")
    + f"SELECT {FOLD_OUT} FROM placed WHERE role IS NOT NULL GROUP BY fold, role",
)
def rolling_folds(spark, folder):
    return fold_counts(splits.rolling_origin_folds(retail.panel(spark, folder)))


@query(
    "c11_expanding_folds",
    with_panel(INDEXED, """
placed AS (SELECT date, demand, fold, CASE WHEN idx < total - (3 - fold) * (total // 4) THEN 'train'
                 WHEN idx < total - (3 - fold) * (total // 4) + (total // 4) THEN 'valid' END AS role
          FROM indexed CROSS JOIN (SELECT unnest([0, 1, 2]) AS fold))""")
    + f"SELECT {FOLD_OUT} FROM placed WHERE role IS NOT NULL GROUP BY fold, role",
)
def expanding(spark, folder):
    return fold_counts(splits.expanding_folds(retail.panel(spark, folder)))


# ---- the 132-column chain -------------------------------------------------

SERIES_CODES = {**{c: c for c in HIERARCHY}, **{c: COMBOS[c] for c in ("state_cat_combined", "store_cat_combined", "store_dept_combined")}}
CALENDAR_CODES = {c: f"COALESCE({c}, 'None')" for c in CALENDAR_TEXT}


def _lag(n: int) -> str:
    return f"LAG(demand, {n}) OVER ({OVER})"


def _base_columns() -> list[str]:
    """Raw window values, named so that the outer select can combine them."""
    out = [f"{_lag(n)} AS lag_{n}" for n in LAGS]
    for n in WINDOWS:
        out += [f"{fn}(demand) OVER {rows(n)} AS {name}_{n}" for fn, name in (("AVG", "mean"), ("STDDEV_SAMP", "std"), ("MAX", "max"), ("MIN", "min"))]
    out += [f"SUM(CASE WHEN demand > 0 THEN 1 ELSE 0 END) OVER {rows(n)} AS active_{n}" for n in ACTIVE_WINDOWS]
    for n in PATTERN_WINDOWS:
        out.append(f"AVG(CASE WHEN demand = 0 THEN 1.0 ELSE 0.0 END) OVER {rows(n)} AS ratio_{n}")
        out.append(f"COALESCE(AVG(CASE WHEN demand > 0 THEN demand END) OVER {rows(n)}, 0) AS intensity_{n}")
    out.append(f"COALESCE(date - {LAST_SALE}, 999) AS since_sale")
    out.append(f"LAG(sell_price) OVER ({OVER}) AS previous_price")
    out += [f"CASE WHEN COUNT(sell_price) OVER {rows(n)} = {n} THEN AVG(sell_price) OVER {rows(n)} END AS momentum_{n}" for n in MOMENTUM_WINDOWS]
    out += [
        "AVG(sell_price) OVER (PARTITION BY item_id) AS item_price", "AVG(sell_price) OVER (PARTITION BY cat_id) AS cat_price",
        "date - COALESCE(MIN(CASE WHEN demand > 0 THEN date END) OVER (PARTITION BY item_id), date) AS age",
        "AVG(demand) OVER (PARTITION BY item_id, date) AS item_day", "date - MIN(date) OVER () AS since_start",
    ]
    return out


def _ewm_ctes() -> list[str]:
    """Weighted sums and weights as a recursion over the day number."""
    qs = {"0_1": 0.9, "0_3": 0.7, "0_5": 0.5}
    first = ", ".join(f"CAST(demand AS DOUBLE) AS s{k}, 1.0::DOUBLE AS w{k}" for k in qs)
    step = ", ".join(f"p.demand + {q} * r.s{k} AS s{k}, 1 + {q} * r.w{k} AS w{k}" for k, q in qs.items())
    return [f"""
smooth AS (
  SELECT store_id, item_id, date, day_num, {first} FROM panel WHERE day_num = 1
  UNION ALL
  SELECT p.store_id, p.item_id, p.date, p.day_num, {step}
  FROM smooth r JOIN panel p ON p.store_id = r.store_id AND p.item_id = r.item_id AND p.day_num = r.day_num + 1)"""]


def chain_sql() -> str:
    head = with_priced(
        MONTHLY,
        *_ewm_ctes(),
        *[codes_cte(c, "panel", x) for c, x in SERIES_CODES.items()],
        *[codes_cte(c, "calendar", x) for c, x in CALENDAR_CODES.items()],
        f"\nbase AS (SELECT *, {', '.join(_base_columns())} FROM priced)",
        "\nrivals AS (SELECT store_id, cat_id, date, COUNT(DISTINCT item_id) AS category_competition FROM panel GROUP BY 1, 2, 3)",
    )
    t = {n: x.replace("date)", "b.date)") for n, x in PARTS.items()}
    out = ["b.id", "b.item_id", "b.dept_id", "b.cat_id", "b.store_id", "b.state_id", "b.d", i("b.demand", "demand"), i("b.day_num", "day_num"),
           d("b.date", "date"), i("b.wm_yr_wk", "wm_yr_wk"), i("c.wday", "wday"), f("b.sell_price", "sell_price")]
    out += [i(f"c.{x}", x) for x in ("snap_CA", "snap_TX", "snap_WI")]
    out += [i(x, n) for n, x in t.items()]
    out += [i("CASE WHEN isodow(b.date) >= 6 THEN 1 ELSE 0 END", "is_weekend"), i("CASE WHEN day(b.date) <= 3 THEN 1 ELSE 0 END", "is_month_start"),
            i("CASE WHEN day(b.date) >= 28 THEN 1 ELSE 0 END", "is_month_end")]
    out += [x for n, p in LIVE.items() for x in wave(t[n], p, (f"{n}_sin", f"{n}_cos"))]
    out += [i("since_start", "days_since_start"), f("dayofyear(b.date) / 365.25", "relative_day_of_year")]
    for n in LAGS:
        out += [i(f"lag_{n}", f"demand_lag_{n}"), f(f"ln(1 + lag_{n})", f"demand_lag_{n}_log"),
                i(f"CASE WHEN lag_{n} > 0 THEN 1 ELSE 0 END", f"demand_lag_{n}_nonzero")]
    out += [i(f"active_{n}", f"active_days_last_{n}") for n in ACTIVE_WINDOWS]
    for n in WINDOWS:
        out += [f(f"mean_{n}", f"demand_rolling_mean_{n}"), f(f"std_{n}", f"demand_rolling_std_{n}"),
                i(f"max_{n}", f"demand_rolling_max_{n}"), i(f"min_{n}", f"demand_rolling_min_{n}"),
                f(f"std_{n} / (mean_{n} + 1e-8)", f"demand_rolling_cv_{n}"),
                f(f"CASE WHEN std_{n} = 0 THEN 0 ELSE (demand - mean_{n}) / (std_{n} + 1e-8) END", f"demand_trend_{n}")]
    out += [f(f"s{k} / w{k} + 1e-9", f"demand_ewm_{k}") for k in ("0_1", "0_3", "0_5")]
    out.append(i("since_sale", "days_since_last_sale"))
    for n in PATTERN_WINDOWS:
        out += [f(f"ratio_{n}", f"intermittency_ratio_{n}"), f(f"intensity_{n}", f"demand_intensity_{n}")]
    out += [f(f"mean_{a} - mean_{b}", f"demand_velocity_{a}_{b}") for a, b in ((7, 14), (14, 28), (28, 56))]
    out += [f("sell_price - previous_price", "price_change"), f("sell_price / previous_price - 1", "price_change_pct"),
            f("sell_price / item_price", "price_vs_item_avg"), f("sell_price / cat_price", "price_vs_cat_avg")]
    out += [f(f"momentum_{n}", f"price_momentum_{n}") for n in MOMENTUM_WINDOWS]
    out += [f("COALESCE(sell_price / previous_price - 1, 0) * COALESCE(lag_7, 0)", "price_elasticity_signal"),
            i("CASE WHEN sell_price - previous_price < -0.01 THEN 1 ELSE 0 END", "is_discount"),
            f("CASE WHEN sell_price - previous_price < 0 THEN abs(sell_price - previous_price) ELSE 0 END", "discount_magnitude")]
    out += [i(f"{c}_encoded") for c in (*SERIES_CODES, *CALENDAR_CODES)]
    out += [i("age", "item_age_days"), f("demand / (item_day + 1e-8)", "store_performance"), i("category_competition"),
            f("month_mean / nullif(item_mean, 0)", "seasonal_strength")]
    out += [f("sell_price * month(b.date)", "price_month_interaction"), f("sell_price * (CASE WHEN isodow(b.date) >= 6 THEN 1 ELSE 0 END)", "price_weekend_interaction"),
            f(f"sell_price * ({ANY})", "price_holiday_interaction"), i("month(b.date) * cat_id_encoded", "month_cat_interaction"),
            i("(isodow(b.date) - 1) * store_id_encoded", "dow_store_interaction"), f("lag_7 * sell_price", "lag7_price_interaction")]
    out += flags({f"{c}_encoded_exists": f"c.{c} IS NOT NULL" for c in CALENDAR_TEXT[1:]})
    series = {n: x.replace("state_id", "b.state_id").replace("store_id", "b.store_id").replace("cat_id", "b.cat_id").replace("dept_id", "b.dept_id").replace("item_id", "b.item_id") for n, x in SERIES_CODES.items()}
    joins = " ".join(f"JOIN code_{n} ON v_{n} = {x}" for n, x in series.items())
    joins += " " + " ".join(f"JOIN code_{n} ON v_{n} = COALESCE(c.{n}, 'None')" for n in CALENDAR_CODES)
    return "WITH RECURSIVE " + head[5:] + f"""SELECT {cols(*out)} FROM base b JOIN calendar c ON c.date = b.date
      JOIN smooth e ON e.store_id = b.store_id AND e.item_id = b.item_id AND e.date = b.date
      JOIN monthly m ON m.item_id = b.item_id AND m.m = month(b.date) JOIN overall o ON o.item_id = b.item_id
      JOIN rivals r ON r.store_id = b.store_id AND r.cat_id = b.cat_id AND r.date = b.date {joins}"""


@query("c12_forecasting_features", chain_sql())
def chain(spark, folder):
    """All 132 columns; the smoothed columns are nudged off exact halves for the comparison."""
    df = features.forecasting_features(retail.sales(spark, folder), retail.calendar(spark, folder), retail.prices(spark, folder))
    nudged = {f"demand_ewm_{k}": F.col(f"demand_ewm_{k}") + 1e-9 for k in ("0_1", "0_3", "0_5")}
    return df.withColumns(nudged)


def integrated(spark, folder):
    """Panel with calendar, raw weekly prices filled per series."""
    days = retail.calendar(spark, folder).drop("date", "wm_yr_wk", "month", "year", "wday")
    return settle(attach(priced(spark, folder), days, ["d"]), "integrated")


def _variant_sql() -> str:
    spans = (7, 14, 28, 56)
    start = ", ".join(f"CAST(demand AS DOUBLE) AS e{n}" for n in spans)
    step = ", ".join(f"{2.0 / (n + 1)!r} * p.demand + (1 - {2.0 / (n + 1)!r}) * r.e{n} AS e{n}" for n in spans)
    coded = {**{c: c for c in HIERARCHY}, **{c: COMBOS[c] for c in ("cat_month", "cat_quarter", "store_month", "store_quarter", "weekend_cat")}}
    base = [f"{_lag(n)} AS lag_{n}" for n in LAGS]
    for n in WINDOWS:
        base += [f"{fn}(demand) OVER {rows(n)} AS {name}_{n}" for fn, name in (("AVG", "mean"), ("STDDEV_SAMP", "std"), ("MAX", "max"), ("MIN", "min"))]
    base += [f"LAG(sell_price) OVER ({OVER}) AS previous_price", f"AVG(sell_price) OVER {rows(28)} AS price_28",
             "AVG(sell_price) OVER (PARTITION BY cat_id, date) AS cat_day", "AVG(sell_price) OVER (PARTITION BY store_id, date) AS store_day"]
    for c in HIERARCHY:
        base += [f"AVG(demand) OVER (PARTITION BY {c}) AS {c}_tm", f"COALESCE(STDDEV_SAMP(demand) OVER (PARTITION BY {c}), 0) AS {c}_ts",
                 f"COUNT(demand) OVER (PARTITION BY {c}) AS {c}_tc"]
    head = with_priced(
        f"""
smooth AS (SELECT store_id, item_id, date, day_num, {start} FROM panel WHERE day_num = 1 UNION ALL
  SELECT p.store_id, p.item_id, p.date, p.day_num, {step} FROM smooth r JOIN panel p
    ON p.store_id = r.store_id AND p.item_id = r.item_id AND p.day_num = r.day_num + 1)""",
        *[codes_cte(n, "panel", x) for n, x in coded.items()],
        f"\nbase AS (SELECT *, {', '.join(base)} FROM priced)",
        "\nedges AS (SELECT quantile_cont(sell_price, [0.2, 0.4, 0.6, 0.8]) AS q FROM priced)",
    )

    def on_b(x: str) -> str:
        for c in (*HIERARCHY, "date"):
            x = x.replace(c, f"b.{c}")
        return x

    t = {n: x.replace("date)", "b.date)") for n, x in PARTS.items()}
    out = ["b.id", "b.item_id", "b.store_id", d("b.date", "date"), i("b.demand", "demand"), f("b.sell_price", "sell_price")]
    out += [i(x, n) for n, x in t.items()] + [i("CASE WHEN isodow(b.date) >= 6 THEN 1 ELSE 0 END", "is_weekend")]
    out += [i(edge(u, k).replace("date =", "b.date =").replace("date +", "b.date +").replace(", date)", ", b.date)"), f"is_{u}_{k}") for u in ("month", "quarter", "year") for k in ("start", "end")]
    out += [x for n, p in VARIANT.items() for x in wave(t[n], p, (f"sin_{n}", f"cos_{n}"))]
    out += [i(f"lag_{n}", f"demand_lag_{n}") for n in LAGS]
    for n in WINDOWS:
        out += [f(f"mean_{n}", f"demand_rolling_mean_{n}"), f(f"std_{n}", f"demand_rolling_std_{n}"), i(f"max_{n}", f"demand_rolling_max_{n}"),
                i(f"min_{n}", f"demand_rolling_min_{n}"), f(f"e{n} + 1e-9", f"demand_ewm_{n}")]
    out += [f("sell_price / previous_price - 1", "price_change"), f("abs(sell_price / previous_price - 1)", "price_change_abs"),
            f("sell_price / cat_day", "price_relative_to_category"), f("sell_price / store_day", "price_relative_to_store"),
            f("price_28", "price_rolling_mean_28"), f("sell_price / price_28", "price_relative_to_avg"),
            "CASE WHEN sell_price <= q[1] THEN 'very_low' WHEN sell_price <= q[2] THEN 'low' WHEN sell_price <= q[3] THEN 'medium' "
            "WHEN sell_price <= q[4] THEN 'high' ELSE 'very_high' END AS price_bin"]
    out += flags({"has_event_1": "c.event_name_1 IS NOT NULL", "has_event_2": "c.event_name_2 IS NOT NULL",
                  "has_any_event": "c.event_name_1 IS NOT NULL OR c.event_name_2 IS NOT NULL"})
    out += [i("snap_CA + snap_TX + snap_WI", "snap_total"), i("CASE WHEN snap_CA + snap_TX + snap_WI > 0 THEN 1 ELSE 0 END", "has_snap")]
    out += [i(f"CASE WHEN {x.replace('date)', 'b.date)')} THEN 1 ELSE 0 END", n) for n, x in HOLIDAYS.items()]
    out += [f(f"sell_price * ({ANY})", "price_event_interaction")]
    for c in HIERARCHY:
        out += [f(f"{c}_tm", f"{c}_target_mean"), f(f"{c}_ts", f"{c}_target_std"), i(f"{c}_tc", f"{c}_target_count")]
    out += [i(f"{n}_encoded") for n in coded]
    joins = " ".join(f"JOIN code_{n} ON v_{n} = {on_b(x)}" for n, x in coded.items())
    return "WITH RECURSIVE " + head[5:] + f"""SELECT {cols(*out)} FROM base b JOIN calendar c ON c.date = b.date CROSS JOIN edges
      JOIN smooth e ON e.store_id = b.store_id AND e.item_id = b.item_id AND e.date = b.date {joins}"""


@query("c13_variant_features", _variant_sql())
def variant(spark, folder):
    df = features.variant_features(integrated(spark, folder))
    nudged = {f"demand_ewm_{n}": F.col(f"demand_ewm_{n}") + 1e-9 for n in (7, 14, 28, 56)}
    unused = [
        "dept_id", "cat_id", "state_id", "d", "day_num", "wm_yr_wk", "weekday", "event_name_1", "event_type_1", "event_name_2",
        "event_type_2", "snap_CA", "snap_TX", "snap_WI", "cat_month", "cat_quarter", "store_month", "store_quarter", "weekend_cat",
    ]
    return df.withColumns(nudged).drop(*unused)


STORE_OUT = [
    *[i(f"LAG(demand, {n}) OVER (PARTITION BY id ORDER BY b.date)", f"demand_lag_{n}") for n in (1, 7, 14, 28)],
    *[x for n in (7, 14, 28) for x in (
        f(f"AVG(demand) OVER (PARTITION BY id ORDER BY b.date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"demand_rolling_mean_{n}"),
        f(f"STDDEV_SAMP(demand) OVER (PARTITION BY id ORDER BY b.date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", f"demand_rolling_std_{n}"))],
    f("sell_price / LAG(sell_price) OVER (PARTITION BY id ORDER BY b.date) - 1", "price_change"),
    f("sell_price / AVG(sell_price) OVER (PARTITION BY cat_id, b.date)", "price_relative_to_category"),
    *flags({f"{c}_exists": f"c.{c} IS NOT NULL" for c in CALENDAR_TEXT[1:]}), i(ANY, "is_holiday"),
    *[x for n, p in (("dayofyear", "365.25"), ("week", "52")) for x in wave(PARTS[n].replace("date)", "b.date)"), p, (f"sin_{n}", f"cos_{n}"))],
]


@query(
    "c14_feature_store",
    with_priced() + f"SELECT {cols('id', d('b.date', 'date'), i('demand'), f('sell_price'), *STORE_OUT)} FROM priced b JOIN calendar c ON c.date = b.date",
)
def store(spark, folder):
    df = features.store_features(integrated(spark, folder))
    unused = [
        "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "day_num", "wm_yr_wk", "weekday", "event_name_1", "event_type_1",
        "event_name_2", "event_type_2", "snap_CA", "snap_TX", "snap_WI", "year", "month", "day", "dayofweek", "dayofyear", "week", "quarter",
    ]
    return df.drop(*unused)


STORE_SPANS = (6, 27)


def _incremental_sql() -> str:
    start = ", ".join(f"CAST(demand AS DOUBLE) AS e{n}" for n in STORE_SPANS)
    step = ", ".join(f"{2.0 / (n + 1)!r} * p.demand + (1 - {2.0 / (n + 1)!r}) * r.e{n} AS e{n}" for n in STORE_SPANS)
    smooth = f"""
smooth AS (SELECT store_id, item_id, date, day_num, {start} FROM panel WHERE day_num = 1 UNION ALL
  SELECT p.store_id, p.item_id, p.date, p.day_num, {step} FROM smooth r JOIN panel p
    ON p.store_id = r.store_id AND p.item_id = r.item_id AND p.day_num = r.day_num + 1)"""
    out = [x for x in STORE_OUT if "LAG" in x or "OVER" in x]
    return "WITH RECURSIVE " + with_priced(smooth)[5:] + f"""SELECT {cols('id', d('b.date', 'date'), i('b.demand', 'demand'), f('sell_price'),
      *[x.replace("(demand", "(b.demand") for x in out], *[f(f"e{n}", f"demand_ewm_{n}") for n in STORE_SPANS])}
      FROM priced b JOIN smooth e ON e.store_id = b.store_id AND e.item_id = b.item_id AND e.date = b.date"""


@query("s09_s10_incremental_store", _incremental_sql())
def incremental_store(spark, folder):
    """The store built in three steps, the last of which also repeats some days, read back."""
    days = integrated(spark, folder)
    first, last = days.agg(F.min("date"), F.max("date")).first()
    one, two = first + (last - first) * 3 // 5, first + (last - first) * 4 // 5
    path = shared_path(spark, "grown")
    create_store(days.where(F.col("date") < F.lit(one)), path, spans=STORE_SPANS)
    append_days(days.where(F.col("date").between(F.lit(one), F.lit(two))), path, spans=STORE_SPANS)
    append_days(days.where(F.col("date") > F.date_sub(F.lit(two), 10)), path, spans=STORE_SPANS)
    names = [x.split(" AS ")[-1] for x in STORE_OUT if "LAG" in x or "OVER" in x]
    return read_store(spark, path).select("id", "date", "demand", "sell_price", *names, *[f"demand_ewm_{n}" for n in STORE_SPANS])


GROUPED = {
    "temporal": ("year", "month", "day", "dayofweek", "dayofyear", "week"), "lag": ("demand_lag_7",),
    "rolling": ("demand_rolling_mean_7",), "price": ("sell_price",),
}
GROUP_VALUES = {**PARTS, "demand_lag_7": _lag(7), "demand_rolling_mean_7": f"AVG(demand) OVER {rows(7)}", "sell_price": "sell_price"}


@query(
    "c07_feature_groups",
    with_priced(
        f"wide AS (SELECT {', '.join(f'{x} AS f_{n}' for n, x in GROUP_VALUES.items())} FROM priced)",
        "means AS (" + " UNION ALL ".join(
            f"SELECT '{g}' AS feature_group, AVG(abs(f_{n})) AS v FROM wide" for g, names in GROUPED.items() for n in names
        ) + ")",
    )
    + f"SELECT feature_group, {i('COUNT(*)', 'features')}, {f('AVG(v)', 'mean_abs', 4)} FROM means GROUP BY feature_group",
    digits=4,
)
def groups(spark, folder):
    """Mean absolute value of every feature group."""
    df = add_rolling(add_lags(priced(spark, folder), [7], detail=False), [7], stats=["mean"]).withColumns(date_parts())
    names = list(GROUP_VALUES)
    means = df.agg(*[F.avg(F.abs(F.col(c).cast("double"))).alias(c) for c in names])
    long = means.unpivot([], names, "feature", "mean_abs")
    group = F.array(*[
        F.when(F.col("feature").isin(members), F.lit(name)) for name, members in prepare.feature_groups(names).items() if members
    ])
    return long.select("feature", "mean_abs", F.explode(F.array_compact(group)).alias("feature_group")).groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("features"), F.avg("mean_abs").alias("mean_abs")
    )
