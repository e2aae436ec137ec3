"""Time-ordered splits and cross-validation folds."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import date_index
from shelfspan.session import shared_path


def split_by_last_days(df: DataFrame, test_days: int = 28, validation_days: int = 28, date: str = "date") -> DataFrame:
    """Label rows train, valid or test counted in days from the latest date."""
    latest = df.agg(F.max(date)).scalar()
    age = F.datediff(latest, F.col(date))
    label = F.when(age < test_days, "test").when(age < test_days + validation_days, "valid").otherwise("train")
    return df.withColumn("split", label)


def _with_index(df: DataFrame, date: str) -> DataFrame:
    return attach(df, date_index(df, date), [date])


def split_by_distinct_dates(df: DataFrame, test_dates: int = 28, validation_dates: int = 28, date: str = "date") -> DataFrame:
    """Label rows by the position of their date among the distinct dates."""
    left = F.col("total_dates") - F.col("date_idx")
    label = F.when(left <= test_dates, "test").when(left <= test_dates + validation_dates, "valid").otherwise("train")
    return _with_index(df, date).withColumn("split", label).drop("date_idx", "total_dates")


def _explode_folds(df: DataFrame, n_splits: int, role) -> DataFrame:
    """One copy of a row per fold that uses it, made where the row is."""
    folds = F.transform(
        F.sequence(F.lit(0), F.lit(n_splits - 1)), lambda fold: F.struct(fold.alias("fold"), role(fold).alias("role"))
    )
    used = F.filter(folds, lambda x: x["role"].isNotNull())
    return df.withColumn("_use", F.explode(used)).select(
        *[c for c in df.columns if c not in ("date_idx", "total_dates")], "_use.fold", "_use.role"
    )


def rolling_origin_folds(
    df: DataFrame, n_splits: int = 3, test_dates: int = 28, validation_dates: int = 28, date: str = "date"
) -> DataFrame:
    """Folds whose validation block steps back from the end; train is all before."""
    idx, total = F.col("date_idx"), F.col("total_dates")
    step = F.floor((total - test_dates - validation_dates) / n_splits)

    def role(fold):
        end = total - test_dates - fold * step
        return F.when(idx < end - validation_dates, "train").when(idx < end, "valid")

    return _explode_folds(_with_index(df, date), n_splits, role)


def expanding_folds(df: DataFrame, n_splits: int = 3, test_dates: int | None = None, date: str = "date") -> DataFrame:
    """Expanding train blocks, each followed by the next block of dates."""
    idx, total = F.col("date_idx"), F.col("total_dates")
    size = F.floor(total / (n_splits + 1)) if test_dates is None else F.lit(test_dates)

    def role(fold):
        start = total - (n_splits - fold) * size
        return F.when(idx < start, "train").when(idx < start + size, "valid")

    return _explode_folds(_with_index(df, date), n_splits, role)


class Fold(NamedTuple):
    """First and last day of the training and of the validation rows, all inclusive."""

    train_from: dt.date
    train_to: dt.date
    valid_from: dt.date
    valid_to: dt.date


def _dates(df: DataFrame, date: str) -> list[dt.date]:
    """Distinct days in order; no more than the calendar has."""
    return [r[0] for r in df.select(F.col(date).cast("date").alias(date)).distinct().where(f"{date} is not null").orderBy(date).collect()]


def _bounds(dates: list[dt.date], cuts: list[tuple[int, int]]) -> list[Fold]:
    """Folds from (first validation place, place behind the last); without a training or a validation day there is none."""
    return [Fold(dates[0], dates[a - 1], dates[a], dates[b - 1]) for a, b in cuts if 0 < a < b <= len(dates)]


def rolling_origin_bounds(df: DataFrame, n_splits: int = 3, test_dates: int = 28, validation_dates: int = 28, date: str = "date") -> list[Fold]:
    """The folds of ``rolling_origin_folds`` as dates."""
    dates = _dates(df, date)
    step = (len(dates) - test_dates - validation_dates) // n_splits
    ends = [len(dates) - test_dates - fold * step for fold in range(n_splits)]
    return _bounds(dates, [(end - validation_dates, end) for end in ends])


def expanding_bounds(df: DataFrame, n_splits: int = 3, test_dates: int | None = None, date: str = "date") -> list[Fold]:
    """The folds of ``expanding_folds`` as dates."""
    dates = _dates(df, date)
    size = len(dates) // (n_splits + 1) if test_dates is None else test_dates
    starts = [len(dates) - (n_splits - fold) * size for fold in range(n_splits)]
    return _bounds(dates, [(start, start + size) for start in starts])


def store_by_month(df: DataFrame, name: str = "by_month", date: str = "date") -> DataFrame:
    """The table written once, one folder for each month, and read back with its ``month_start``."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.withColumn("month_start", F.trunc(date, "MM").cast("date")).repartition("month_start", F.pmod(F.xxhash64(*[c for c in df.columns if c != "features"]), F.lit(8))).write.partitionBy("month_start").parquet(path)
    return spark.read.parquet(path)


def fold_rows(stored: DataFrame, fold: Fold, role: str, date: str = "date") -> DataFrame:
    """Training or validation rows of a fold; only the months in question are read, and no row is copied."""
    low, high = (fold.train_from, fold.train_to) if role == "train" else (fold.valid_from, fold.valid_to)
    months = F.col("month_start").between(low.replace(day=1), high.replace(day=1))
    return stored.where(months & F.col(date).between(low, high)).drop("month_start")
