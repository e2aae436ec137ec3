"""Demand tables derived from the star-schema test tables.

Brands play the items, regions the stores; every date of the line items is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspan.operators.demand import mean_forecast, naive_forecast
from shelfspan.operators.panel import daily_sums, densify, expand_gaps
from shelfspan.session import settle


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def state_of(key) -> F.Column:
    return F.when(key % 3 == 0, "CA").when(key % 3 == 1, "TX").otherwise("WI")


def sale_lines(spark: SparkSession, folder: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Line items with item, store, date, quantity and unit price in whole cents."""
    lineitem = table(spark, folder, "lineitem") if lineitem is None else lineitem
    lines = lineitem.select(
        "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity", "l_extendedprice"
    )
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item_id"))
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("store_id"), state_of(F.col("r_regionkey")).alias("state_id")
    )
    keyed = lines.join(part, "l_partkey").join(supplier, "l_suppkey")
    return keyed.join(nation, "s_nationkey").join(region, "n_regionkey").select(
        "item_id", "store_id", "state_id", "date", F.col("l_quantity").alias("quantity"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100).alias("unit_price"),
    )


def date_bounds(lineitem: DataFrame) -> tuple[F.Column, F.Column]:
    """First and last ship date as scalar subqueries, which Spark merges into one scan."""
    first, last = F.min("l_shipdate"), F.max("l_shipdate")
    return lineitem.agg(F.to_date(first)).scalar(), lineitem.agg(F.to_date(last)).scalar()


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Dense daily demand with its hierarchy, day label and day number."""
    keys = ("store_id", "item_id", "state_id")
    lines = sale_lines(spark, folder).select(*keys, "date", F.col("quantity").alias("demand"))
    # The fact table is read once; its dates are those of the stored sums.
    sums = settle(daily_sums(lines, keys, whole=True), "daily")
    low, high = sums.agg(F.min("date")).scalar(), sums.agg(F.max("date")).scalar()
    dense = expand_gaps(sums, low, high, keys)
    brand = F.regexp_extract("item_id", "([0-9]+)", 1).cast("int")
    day_num = F.datediff(F.col("date"), low) + 1
    cat = F.concat(F.lit("CAT_"), (brand % 3).cast("string"))
    return dense.select(
        F.concat_ws("_", "item_id", "store_id").alias("id"),
        "item_id",
        F.concat_ws("_", cat, (brand % 2).cast("string")).alias("dept_id"),
        cat.alias("cat_id"),
        "store_id",
        "state_id",
        F.concat(F.lit("d_"), day_num.cast("string")).alias("d"),
        "demand",
        day_num.alias("day_num"),
        "date",
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """The panel as a melted sales table: no date, only the day label."""
    return panel(spark, folder).drop("date")


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day with week number, names, holidays and programme flags."""
    bounds = table(spark, folder, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("low"), F.to_date(F.max("l_shipdate")).alias("high")
    )
    days = bounds.select("low", F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("date"))
    offset = F.datediff(F.col("date"), F.col("low"))
    stamp = F.date_format("date", "MM-dd")
    # Holidays of the derived calendar.
    name_1 = (
        F.when(stamp == "01-01", "NewYear")
        .when(stamp == "02-14", "ValentinesDay")
        .when(stamp == "05-05", "CincoDeMayo")
        .when(stamp == "07-04", "IndependenceDay")
        .when(stamp == "10-31", "Halloween")
        .when(stamp == "12-25", "Christmas")
    )
    type_1 = F.when(stamp.isin("01-01", "07-04", "12-25"), "National").when(
        stamp.isin("02-14", "05-05", "10-31"), "Cultural"
    )
    name_2 = F.when(stamp == "12-25", "WinterFestival").when(stamp == "05-05", "SpringFair")
    type_2 = F.when(stamp == "12-25", "Religious").when(stamp == "05-05", "Cultural")
    snap = [F.when((F.dayofmonth("date") + shift) % 5 == 0, 1).otherwise(0) for shift in (0, 1, 2)]
    return days.select(
        "date",
        (F.floor(offset / 7) + 1).cast("int").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.weekday("date") + 1).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.concat(F.lit("d_"), (offset + 1).cast("string")).alias("d"),
        name_1.alias("event_name_1"),
        type_1.alias("event_type_1"),
        name_2.alias("event_name_2"),
        type_2.alias("event_type_2"),
        snap[0].alias("snap_CA"),
        snap[1].alias("snap_TX"),
        snap[2].alias("snap_WI"),
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Highest unit price per store, item and week; weeks without sales are missing."""
    lineitem = table(spark, folder, "lineitem")
    low, _ = date_bounds(lineitem)
    week = (F.floor(F.datediff(F.col("date"), low) / 7) + 1).cast("int")
    return sale_lines(spark, folder, lineitem).groupBy("store_id", "item_id", week.alias("wm_yr_wk")).agg(
        F.max("unit_price").alias("sell_price")
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Daily weather-like measures per state from the orders."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    keyed = orders.join(customer, "o_custkey").join(nation, "c_nationkey")
    top, low = F.max("o_totalprice"), F.min("o_totalprice")
    n = F.count(F.lit(1))
    return keyed.groupBy(F.to_date("o_orderdate").alias("date"), state_of(F.col("n_regionkey")).alias("state_id")).agg(
        (top / 5000).alias("tempmax"),
        (low / 5000).alias("tempmin"),
        ((top + low) / 10000).alias("temp"),
        (n * 7 % 101).cast("double").alias("humidity"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("precip"),
        F.count_distinct("o_custkey").cast("double").alias("windspeed"),
        (n * 3 % 101).cast("double").alias("cloudcover"),
        F.when(F.count_if(F.col("o_orderpriority") == "1-URGENT") > 0, "Rain").otherwise("Clear").alias("conditions"),
    )


def economic_long(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly order counts per status, as indicator series."""
    # Order status to indicator name.
    status = F.col("o_orderstatus")
    name = F.when(status == "O", "UNRATE").when(status == "F", "UMCSENT").when(status == "P", "CPIAUCSL")
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date(F.trunc("o_orderdate", "MM")).alias("date"), name.alias("series_id"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .where(F.col("series_id").isNotNull())
    )


def forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Forecast frame of two simple models over every day of the panel."""
    base = panel(spark, folder).select("store_id", "item_id", "cat_id", "date", "demand")
    both = base.select(
        "store_id", "item_id", "cat_id", "date", F.col("demand").cast("double").alias("y_true"),
        naive_forecast().cast("double").alias("naive"), mean_forecast(7).alias("ma7"),
    )
    return both.unpivot(["store_id", "item_id", "cat_id", "date", "y_true"], ["naive", "ma7"], "model", "y_pred")


def event_panel(spark: SparkSession, folder: str) -> DataFrame:
    """A second panel: events per user and type, day by day."""
    events = table(spark, folder, "events")
    moves = events.select(
        F.col("user_id").cast("string").alias("store_id"), F.col("event_type").alias("item_id"),
        F.to_date("ts").alias("date"), F.lit(1).alias("demand"),
    )
    low = events.agg(F.to_date(F.min("ts"))).scalar()
    high = events.agg(F.to_date(F.max("ts"))).scalar()
    return densify(moves, low, high, whole=True)
