"""The three feature chains as single lazy plans over one series window."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import (
    cyclic,
    date_parts,
    event_flags,
    flag,
    holiday_windows,
    near_month_edges,
    period_edges,
    ratio,
    snap_flags,
    weekend,
)
from shelfspan.operators.business import item_age, item_month_profile
from shelfspan.operators.demand import (
    activity_columns,
    add_ewm,
    add_lags,
    add_recursive_ewm,
    add_rolling,
    days_since_sale,
    intermittency_columns,
    lag_columns,
    lag_details,
    rolling_columns,
    spread_columns,
    velocity_columns,
)
from shelfspan.operators.encode import add_target_encoding, apply_codes, category_values, fit_codes
from shelfspan.operators.interactions import (
    HIERARCHY_COMBINATIONS,
    SEASON_COMBINATIONS,
    add_combinations,
    code_interactions,
    price_elasticity,
    price_interactions,
)
from shelfspan.operators.joins import attach, join_prices
from shelfspan.operators.panel import series_window
from shelfspan.operators.price import (
    add_group_ratio,
    add_price_bin,
    add_relative_change,
    add_rolling_price,
    discount_columns,
    fill_prices,
    momentum_columns,
    relative_change,
)
from shelfspan.schemas import CALENDAR, CALENDAR_TEXT, EPSILON, EVENT_COLUMNS, HIERARCHY, SERIES
from shelfspan.session import settle, shared_folder


def temporal_columns(start: F.Column) -> dict[str, F.Column]:
    """Approximate month edges, cycles and positions over existing calendar parts."""
    added = near_month_edges(F.col("day"))
    # Periods of the cyclic encodings.
    for name, period in (("month", 12), ("dayofweek", 7), ("day", 31)):
        added[f"{name}_sin"], added[f"{name}_cos"] = cyclic(F.col(name), period)
    added["days_since_start"] = F.datediff(F.col("date"), start)
    added["relative_day_of_year"] = F.col("dayofyear") / 365.25
    return added


def add_temporal(df: DataFrame, start: F.Column) -> DataFrame:
    """Calendar parts, approximate month edges, cycles and positions."""
    return df.withColumns({**date_parts(), "is_weekend": weekend()}).withColumns(temporal_columns(start))


def add_temporal_variant(df: DataFrame) -> DataFrame:
    """Calendar parts, true period edges and cycles."""
    df = df.withColumns({**date_parts(), "is_weekend": weekend(), **period_edges()})
    added = {}
    # Periods of the cyclic encodings.
    for name, period in (("dayofyear", 365.25), ("week", 52), ("month", 12), ("dayofweek", 7)):
        added[f"sin_{name}"], added[f"cos_{name}"] = cyclic(F.col(name), period)
    return df.withColumns(added)


def encode_calendar(calendar: DataFrame, codes: DataFrame) -> DataFrame:
    """Calendar with its parts, cycles, event flags and codes; its texts are dropped.

    Everything that depends on the day alone is computed once per day.
    """
    events = {f"{c}_encoded_exists": flag(F.col(c).isNotNull()) for c in EVENT_COLUMNS}
    dated = add_temporal(calendar, calendar.agg(F.min("date")).scalar()).withColumns({**events, **event_flags()})
    coded = apply_codes(dated, codes, CALENDAR_TEXT, missing="None")
    return coded.drop("has_event_1", "has_event_2", *CALENDAR_TEXT)


def price_panel(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Sales with date, week and filled price, stored once."""
    dated = attach(sales, calendar.select("d", "date", "wm_yr_wk"), ["d"])
    return settle(fill_prices(join_prices(dated, prices)), "priced")


def forecasting_features(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """The 132-column feature table of the training path.

    The priced panel is stored once. Group statistics come from it in three
    small aggregates and are joined while rows are narrow; the wide window
    features follow behind a single exchange on the series. Columns a calendar
    reader may have added are left out and computed here.
    """
    calendar = calendar.select(*CALENDAR.fieldNames())
    priced = price_panel(sales, calendar, prices)
    return forecasting_features_from(priced, calendar)


def _lookups(priced: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """Stored lookup tables of the chain; independent ones are written side by side."""

    def codes():
        series = settle(add_combinations(priced.select(*HIERARCHY).distinct(), HIERARCHY_COMBINATIONS), "series")
        days = settle(calendar, "calendar")
        columns = [*HIERARCHY, *HIERARCHY_COMBINATIONS]
        table = fit_codes(category_values(series, columns).unionByName(category_values(days, CALENDAR_TEXT, "None")))
        coded = apply_codes(series, table, columns)
        return {
            "series": settle(coded.drop("dept_id", "cat_id", "state_id", *HIERARCHY_COMBINATIONS), "coded_series"),
            "calendar": settle(encode_calendar(days, table).drop("date", "wm_yr_wk"), "coded_calendar"),
        }

    def profile():
        table = settle(item_month_profile(priced), "profile")
        means = table.groupBy("cat_id").agg(ratio(F.sum("price_sum"), F.sum("price_count")).alias("cat_price_mean"))
        return {"item_month": table, "category": settle(means, "category")}

    def item_day():
        means = priced.groupBy("date", "item_id").agg(F.avg("demand").alias("item_day_mean"))
        return {"item_day": settle(means, "item_day")}

    def store_category():
        rivals = priced.groupBy("store_id", "cat_id", "date").agg(F.count_distinct("item_id").alias("category_competition"))
        return {"store_category": settle(rivals, "store_category")}

    shared_folder(priced.sparkSession)
    tasks = [inheritable_thread_target(priced.sparkSession)(task) for task in (codes, profile, item_day, store_category)]
    with ThreadPoolExecutor(len(tasks)) as pool:
        done = [pool.submit(task) for task in tasks]
        return {name: table for job in done for name, table in job.result().items()}


def forecasting_features_from(priced: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same table from an already priced panel.

    Lookups that may have to shuffle are joined first, while rows are narrow.
    All window columns follow in one step behind one exchange on the series;
    calendar and series columns come last, by broadcast or on the same key.
    """
    tables = _lookups(priced, calendar)
    per_item_month = tables["item_month"].select("item_id", "cat_id", "_m", "item_price_mean", "first_sale", "seasonal_strength")

    df = priced.withColumn("_m", F.month("date"))
    df = attach(df, per_item_month, ["item_id", "cat_id", "_m"], spread_by=["store_id", "date"], settled=True).drop("_m")
    df = attach(df, tables["category"], ["cat_id"], spread_by=["item_id", "store_id", "date"], settled=True)
    df = attach(df, tables["item_day"], ["date", "item_id"], spread_by=["store_id"], settled=True)
    df = attach(df, tables["store_category"], ["store_id", "cat_id", "date"], spread_by=["item_id"], settled=True)

    price = F.col("sell_price")
    df = df.withColumns(
        {
            **lag_columns(), **activity_columns(), **rolling_columns(), **intermittency_columns(), **momentum_columns(),
            "days_since_last_sale": days_since_sale(),
            # The filled price has no gaps left to pad, so the last row is the last known one.
            "_last_price": F.lag("sell_price").over(series_window()),
        }
    )
    df = add_ewm(df)
    df = attach(df, tables["series"], SERIES, settled=True)
    df = attach(df, tables["calendar"], ["d"], settled=True)
    df = df.withColumns({"price_change": price - F.col("_last_price"), "price_change_pct": relative_change(price, F.col("_last_price"))})
    df = df.withColumns(
        {
            **lag_details(), **spread_columns(), **velocity_columns(), **discount_columns(), **price_interactions(), **code_interactions(),
            "price_vs_item_avg": ratio(price, F.col("item_price_mean")),
            "price_vs_cat_avg": ratio(price, F.col("cat_price_mean")),
            "price_elasticity_signal": price_elasticity(),
            "item_age_days": item_age(),
            "store_performance": F.col("demand") / (F.col("item_day_mean") + EPSILON),
        }
    )
    return df.drop("item_price_mean", "cat_price_mean", "first_sale", "item_day_mean", "has_any_event", "_last_price")


def variant_features(integrated: DataFrame, target: str = "demand") -> DataFrame:
    """The second feature set, over an integrated panel keyed by ``id``.

    Expects a stored table (it is read several times) with ids, date, demand,
    sell_price, event names and snap columns. Weather and indicator features are
    separate steps, on the tables those signals come in.
    """
    key = ["id"]
    snaps = [c for c in integrated.columns if c.startswith("snap_")]
    df = add_group_ratio(integrated, "sell_price", ["cat_id", "date"], "price_relative_to_category")
    df = add_group_ratio(df, "sell_price", ["store_id", "date"], "price_relative_to_store")
    df = add_target_encoding(df, HIERARCHY, target)
    df = add_price_bin(df)
    df = add_temporal_variant(df)
    df = add_combinations(df.withColumns({**event_flags(), **snap_flags(snaps), **holiday_windows()}), SEASON_COMBINATIONS)
    columns = [*HIERARCHY, *SEASON_COMBINATIONS]
    seasons = integrated.select(
        *HIERARCHY, F.month("date").alias("month"), F.quarter("date").alias("quarter"), weekend().alias("is_weekend")
    ).distinct()
    codes = fit_codes(category_values(add_combinations(seasons, SEASON_COMBINATIONS), columns))
    df = apply_codes(df, codes, columns, spread_by=["id", "date"])
    df = add_recursive_ewm(add_rolling(add_lags(df, keys=key, detail=False), keys=key), keys=key)
    df = add_rolling_price(add_relative_change(df, "price_change", "sell_price", key), keys=key)
    return df.withColumns(
        {
            "price_change_abs": F.abs(F.col("price_change")),
            "price_event_interaction": F.col("sell_price") * F.col("has_any_event"),
        }
    )


def store_features(integrated: DataFrame, lags: Sequence[int] = (1, 7, 14, 28), windows: Sequence[int] = (7, 14, 28)) -> DataFrame:
    """The compact feature store written by the integration step."""
    key = ["id"]
    df = add_group_ratio(integrated, "sell_price", ["cat_id", "date"], "price_relative_to_category")
    parts = date_parts()
    df = df.withColumns({name: parts[name] for name in ("year", "month", "day", "dayofweek", "dayofyear", "week", "quarter")})
    exists = {f"{c}_exists": flag(F.col(c).isNotNull()) for c in EVENT_COLUMNS}
    df = df.withColumns({**exists, "is_holiday": event_flags()["has_any_event"]})
    added = {}
    # Periods of the cyclic encodings.
    for name, period in (("dayofyear", 365.25), ("week", 52)):
        added[f"sin_{name}"], added[f"cos_{name}"] = cyclic(F.col(name), period)
    df = df.withColumns(added)
    df = add_rolling(add_lags(df, lags, key, detail=False), windows, key, stats=("mean", "std"))
    return add_relative_change(df, "price_change", "sell_price", key)
