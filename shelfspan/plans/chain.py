"""The feature chain as a fitted, storable estimator without leaks.

``DemandChain`` learns from training rows what the chain looks up: category
codes, item and category price levels, first sales, month profiles and target
statistics. ``DemandChainModel`` keeps these as tables, saves and loads them
with a pipeline, and computes the features of any rows from them; windows see
strictly earlier days only.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.functions.scalar import date_parts, event_flags, flag, ratio, weekend
from shelfspan.operators.business import item_age, item_month_profile
from shelfspan.operators.demand import (
    activity_columns, add_ewm, days_since_sale, intermittency_columns, lag_columns, lag_details, rolling_columns, spread_columns, velocity_columns,
)
from shelfspan.operators.encode import apply_codes_or_unknown, category_values, fit_codes
from shelfspan.operators.interactions import HIERARCHY_COMBINATIONS, add_combinations, code_interactions, price_elasticity, price_interactions
from shelfspan.operators.joins import attach
from shelfspan.operators.panel import series_window
from shelfspan.operators.price import discount_columns, momentum_columns, relative_change
from shelfspan.plans.features import temporal_columns
from shelfspan.schemas import CALENDAR_TEXT, EPSILON, EVENT_COLUMNS, EWM_ALPHAS, HIERARCHY, SALES_IDS, SERIES, SNAP_COLUMNS
from shelfspan.session import settle

LABEL = "demand"
NEEDED = (*SALES_IDS, "date", "demand", "sell_price", *CALENDAR_TEXT, *SNAP_COLUMNS)
#: Labels of rows that come out as they came in.
PASSED = ("split", "fold", "role")
TABLES = ("codes", "items", "item_months", "categories", "targets")
NONE = "None"


def target_table(rows: DataFrame, columns=HIERARCHY, target: str = LABEL) -> DataFrame:
    """``column, value, target_mean, target_std, target_count`` of every category; one pass, summed map-side."""
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    each = rows.select(F.col(target).cast("double").alias("_y"), sides.alias("_side")).select("_y", "_side.*").where("value is not null")
    return each.groupBy("column", "value").agg(
        F.avg("_y").alias("target_mean"), F.coalesce(F.stddev_samp("_y"), F.lit(0.0)).alias("target_std"), F.count("_y").alias("target_count")
    )


class _ChainParams(Params):
    start = Param(Params._dummy(), "start", "first training day", TypeConverters.toString)
    columns = Param(Params._dummy(), "columns", "names of the features", TypeConverters.toListString)


class DemandChain(Estimator, _ChainParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the chain's lookups from the rows it is given, and only these.

    Rows hold ids, date, demand, filled price, calendar texts and programme
    flags. Null categories get no code of their own. With no rows at all there
    is nothing to learn, which raises.
    """

    @keyword_only
    def __init__(self):
        super().__init__()

    def _fit(self, dataset: DataFrame) -> DemandChainModel:
        rows = settle(dataset.select(*NEEDED), "chain_rows")
        start = rows.agg(F.min("date")).first()[0]
        if start is None:
            raise ValueError("the chain needs at least one dated training row")
        series = add_combinations(rows.select(*HIERARCHY).distinct(), HIERARCHY_COMBINATIONS)
        texts = category_values(series, [*HIERARCHY, *HIERARCHY_COMBINATIONS]).unionByName(
            category_values(rows.select(*CALENDAR_TEXT).distinct(), CALENDAR_TEXT, NONE)
        )
        profile = settle(item_month_profile(rows), "profile")
        per_item = profile.groupBy("item_id").agg(F.max("item_price_mean").alias("item_price_mean"), F.min("first_sale").alias("first_sale"))
        model = DemandChainModel()
        model._set(start=str(start))
        model.tables = {
            "codes": fit_codes(texts),
            "items": settle(per_item, "items"),
            "item_months": settle(profile.groupBy("item_id", F.col("_m").alias("month")).agg(F.max("seasonal_strength").alias("seasonal_strength")), "item_months"),
            "categories": settle(profile.groupBy("cat_id").agg(ratio(F.sum("price_sum"), F.sum("price_count")).alias("cat_price_mean")), "categories"),
            "targets": settle(target_table(rows), "targets"),
        }
        ids = {*SALES_IDS, "date", LABEL, *PASSED}
        return model._set(columns=[c for c in model.transform(rows.limit(1)).columns if c not in ids])


class _ChainWriter(MLWriter):
    def __init__(self, instance: DemandChainModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _ChainReader(MLReader):
    def load(self, path: str) -> DemandChainModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = DemandChainModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.tables = {name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in TABLES}
        return model


class DemandChainModel(Model, _ChainParams, MLReadable, MLWritable):
    """Features of any rows from the stored lookups.

    The rows bring the history their windows need; a row's own demand enters no
    feature of it. Unseen categories share one code behind the known ones; items
    that training never met have null price levels and strengths, and count as
    not sold before.
    """

    def __init__(self):
        super().__init__()
        self._setDefault(columns=[])
        self.tables: dict[str, DataFrame] = {}

    def write(self) -> MLWriter:
        return _ChainWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ChainReader()

    def _series(self, rows: DataFrame) -> DataFrame:
        """Codes and target statistics of every series."""
        columns = [*HIERARCHY, *HIERARCHY_COMBINATIONS]
        series = add_combinations(rows.select(*HIERARCHY).distinct(), HIERARCHY_COMBINATIONS)
        coded = apply_codes_or_unknown(series, self.tables["codes"], columns)
        for c in HIERARCHY:
            own = self.tables["targets"].where(F.col("column") == c)
            own = own.select(F.col("value").alias(c), *[F.col(f"target_{x}").alias(f"{c}_target_{x}") for x in ("mean", "std", "count")])
            coded = attach(coded, own, [c], spread_by=[x for x in HIERARCHY if x != c])
        return settle(coded.drop("dept_id", "cat_id", "state_id", *HIERARCHY_COMBINATIONS), "coded_series")

    def _days(self, rows: DataFrame) -> DataFrame:
        """Calendar parts, event flags and codes of every day with its texts."""
        days = rows.select("date", *CALENDAR_TEXT).distinct()
        named = days.withColumns({f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in CALENDAR_TEXT})
        exists = {f"{c}_encoded_exists": flag(F.col(c).isNotNull()) for c in EVENT_COLUMNS}
        dated = named.withColumns({**date_parts(), "is_weekend": weekend()})
        dated = dated.withColumns({**temporal_columns(F.lit(self.getOrDefault(self.start)).cast("date")), **exists, **event_flags()})
        dated = dated.drop("has_event_1", "has_event_2", *CALENDAR_TEXT).withColumnsRenamed({f"_{c}": c for c in CALENDAR_TEXT})
        return settle(apply_codes_or_unknown(dated, self.tables["codes"], CALENDAR_TEXT).withColumnsRenamed({c: f"_{c}" for c in CALENDAR_TEXT}), "coded_days")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = dataset.select(*NEEDED, *[c for c in PASSED if c in dataset.columns])
        series, days = self._series(rows), self._days(rows)
        # Narrow lookups first, then all windows behind one exchange on the series.
        df = rows.withColumn("_m", F.month("date"))
        df = attach(df, self.tables["items"], ["item_id"], spread_by=["store_id", "date"], settled=True)
        df = attach(df, self.tables["item_months"].withColumnRenamed("month", "_m"), ["item_id", "_m"], spread_by=["store_id", "date"], settled=True).drop("_m")
        df = attach(df, self.tables["categories"], ["cat_id"], spread_by=["item_id", "store_id", "date"], settled=True)
        w = series_window()
        df = df.withColumns(
            {
                **lag_columns(), **activity_columns(shift=1), **rolling_columns(shift=1), **intermittency_columns(shift=1), **momentum_columns(),
                "days_since_last_sale": days_since_sale(), "_yesterday": F.lag(LABEL).over(w), "_last_price": F.lag("sell_price").over(w),
            }
        )
        smooth = [f"{LABEL}_ewm_{str(a).replace('.', '_')}" for a in EWM_ALPHAS]
        df = add_ewm(df).withColumns({c: F.lag(c).over(w) for c in smooth})
        df = attach(df, series, SERIES, settled=True)
        # A day has one row for each combination of its texts, as a rule one.
        texts = {f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in CALENDAR_TEXT}
        df = attach(df.withColumns(texts), days, ["date", *texts], spread_by=["store_id", "item_id"], settled=True).drop(*texts, *CALENDAR_TEXT)
        # Row-wise features that speak of demand get yesterday's.
        df = df.withColumnsRenamed({LABEL: "_label", "_yesterday": LABEL})
        price = F.col("sell_price")
        df = df.withColumns({"price_change": price - F.col("_last_price"), "price_change_pct": relative_change(price, F.col("_last_price"))})
        df = df.withColumns(
            {
                **lag_details(), **spread_columns(), **velocity_columns(), **discount_columns(), **price_interactions(), **code_interactions(),
                "price_vs_item_avg": ratio(price, F.col("item_price_mean")),
                "price_vs_cat_avg": ratio(price, F.col("cat_price_mean")),
                "price_elasticity_signal": price_elasticity(),
                "item_age_days": item_age(),
                "store_performance": F.col(LABEL) / (F.col("item_id_target_mean") + EPSILON),
            }
        )
        return df.drop(LABEL, "item_price_mean", "cat_price_mean", "first_sale", "_last_price", "has_any_event").withColumnRenamed("_label", LABEL)
