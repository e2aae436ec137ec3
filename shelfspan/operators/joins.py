"""Join helpers whose strategy follows a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.session import settle

BROADCAST_ROWS = 500_000
SALTS = 32


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    settled: bool = False,
    limit: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join a lookup that is expected to be small, but only broadcast it if it is.

    The lookup is written once and its rows are counted from the file footers.
    Up to ``limit`` rows it is broadcast. Beyond that the join shuffles; with
    ``spread_by`` each key is split over ``salts`` tasks, so that a key holding a
    large share of the facts does not land in one task. The salt is a hash of
    row values, hence a retried task places every row as before.
    """
    on = list(on)
    lookup = lookup if settled else settle(lookup, "lookup")
    if lookup.count() <= limit:
        return facts.join(F.broadcast(lookup), on, how)
    if not spread_by:
        return facts.join(lookup, on, how)
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted_facts.join(copies, [*on, "_salt"], how).drop("_salt")


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales left join calendar on the day label."""
    return attach(sales, calendar, ["d"], settled=True)


def join_prices(sales: DataFrame, prices: DataFrame) -> DataFrame:
    """Sales left join weekly prices; both sides may be large, so it shuffles."""
    return sales.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")


def join_weather(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join of the four daily weather measures by date and state."""
    signal = weather.select("date", "state_id", "temp", "humidity", "precip", "windspeed")
    return attach(sales, signal, ["date", "state_id"], spread_by=["store_id", "item_id"])


def join_economic(sales: DataFrame, economic: DataFrame) -> DataFrame:
    """Left join of monthly indicators by calendar month."""
    monthly = economic.withColumn("_month", F.trunc("date", "MM")).drop("date")
    keyed = sales.withColumn("_month", F.trunc("date", "MM"))
    return attach(keyed, monthly, ["_month"], spread_by=["store_id", "item_id"]).drop("_month")


def keep_known(df: DataFrame, known: DataFrame, column: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """Rows whose value of ``column`` occurs in ``known``."""
    return attach(df, known.select(column).distinct(), [column], how="left_semi", spread_by=spread_by)


def unseen_values(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` that do not occur in ``known``."""
    return df.select(column).distinct().join(known.select(column), column, "left_anti")


def align_forecasts(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per-model predictions matched on their key instead of by array position."""
    merged = None
    for model, frame in frames.items():
        part = frame.select(*keys, F.lit(model).alias("model"), "y_pred")
        merged = part if merged is None else merged.unionByName(part)
    return spread_models(merged, list(frames), keys)


def spread_models(forecasts: DataFrame, models: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One column per model from rows ``(keys, model, y_pred)``, for the keys that every model has.

    One aggregate, so the rows are read and exchanged once for any number of
    models. A key holds at most one row of each model; null keys match nothing.
    """
    own = {m: F.col("model") == m for m in models}
    complete = forecasts.where(F.col("model").isin(*models)).dropna(subset=list(keys)).groupBy(*keys).agg(
        *[F.max(F.when(own[m], F.col("y_pred"))).alias(m) for m in models],
        F.least(*[F.count_if(own[m]) for m in models], F.lit(1)).alias("_known"),
    )
    return complete.where(F.col("_known") > 0).drop("_known")


def outer_chain(tables: Sequence[DataFrame], key: str = "date") -> DataFrame:
    """Full outer join of several narrow tables on one key."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.join(table, key, "full_outer")
    return merged
