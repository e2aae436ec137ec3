"""Global order, exact percentiles and code tables without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.operators.joins import attach
from shelfspan.session import settle


def running_totals(df: DataFrame, order_by: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Add ``<weight>_before``: the sum of ``weight`` over all rows sorted before.

    Rows are range-partitioned by ``order_by`` (which must be unique), every
    slice is summed, and each row adds the offset of its slice to a running sum
    inside the slice. The offsets table has one row per slice.
    """
    placed = df.repartitionByRange(*order_by).withColumn("_slice", F.spark_partition_id())
    placed = settle(placed, "slices")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_slice").agg(*[F.sum(w).alias(w) for w in weights])
    offsets = totals.select(
        "_slice", *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_{w}_offset") for w in weights]
    )
    inside = Window.partitionBy("_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(F.broadcast(offsets), "_slice")
    before = {f"{w}_before": F.sum(w).over(inside) - F.col(w) + F.col(f"_{w}_offset") for w in weights}
    return joined.withColumns(before).drop("_slice", *[f"_{w}_offset" for w in weights])


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated percentiles as rows ``(*by, column, p, value)``.

    Equal values are counted before anything is sorted, so repeated values cost
    one row each, and no group is gathered in one task.
    """
    by = list(by)
    group = [*by, "column"]
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    counts = (
        numbers.unpivot(by, list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy(*group, "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    ranked = running_totals(counts, [*group, "value"], ["rows"])
    groups = ranked.groupBy(*group).agg(
        F.min("rows_before").alias("_start"), F.sum("rows").alias("_n")
    )
    placed = attach(ranked, groups, group, spread_by=["value"])
    first = F.col("rows_before") - F.col("_start")
    last = first + F.col("rows")

    def reach(p):
        position = (F.col("_n") - 1) * p
        low = F.floor(position)
        high = F.least(low + 1, F.col("_n") - 1)
        return F.struct(
            p.alias("p"),
            (position - low).alias("share"),
            ((low >= first) & (low < last)).alias("is_low"),
            ((high >= first) & (high < last)).alias("is_high"),
        )

    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    hits = placed.select(
        *group, "value", F.explode(F.filter(F.transform(wanted, reach), lambda s: s["is_low"] | s["is_high"])).alias("hit")
    )
    low_value = F.max(F.when(F.col("hit.is_low"), F.col("value")))
    high_value = F.max(F.when(F.col("hit.is_high"), F.col("value")))
    return hits.groupBy(*group, F.col("hit.p").alias("p")).agg(
        (low_value + (high_value - low_value) * F.max("hit.share")).alias("value")
    )


def percentile_columns(df: DataFrame, column: str, names: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Percentiles of one column laid out as one column per probability."""
    rows = exact_percentiles(df, [column], list(names.values()), by)
    picked = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(name) for name, p in names.items()]
    return rows.groupBy(*by).agg(*picked)


def code_table(values: DataFrame) -> DataFrame:
    """Alphabetical zero-based codes for distinct ``(column, value)`` rows."""
    ordered = running_totals(
        values.select("column", "value").distinct().withColumn("one", F.lit(1).cast("long")), ["column", "value"], ["one"]
    )
    starts = ordered.groupBy("column").agg(F.min("one_before").alias("_start"))
    return ordered.join(F.broadcast(starts), "column").select(
        "column", "value", (F.col("one_before") - F.col("_start")).alias("code")
    )


def date_index(df: DataFrame, column: str = "date") -> DataFrame:
    """Distinct dates with their zero-based index and their number.

    The window sees one row per calendar day, never the panel.
    """
    dates = df.select(column).distinct()
    ordered = Window.orderBy(column)
    return dates.select(
        column,
        (F.row_number().over(ordered) - 1).alias("date_idx"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("total_dates"),
    )


def nth_last_date(df: DataFrame, n: int, column: str = "date") -> DataFrame:
    """The n-th distinct date counted from the end."""
    index = date_index(df, column)
    return index.where(F.col("date_idx") == F.col("total_dates") - n).select(column)


def top_k(df: DataFrame, column: str, k: int, tie: str) -> DataFrame:
    """Largest ``k`` rows; ties are broken by a named column."""
    return df.orderBy(F.col(column).desc(), F.col(tie)).limit(k)


def first_items(df: DataFrame, n: int, item: str = "item_id", seen: str = "date") -> DataFrame:
    """The first ``n`` distinct items by first appearance, then name."""
    return df.groupBy(item).agg(F.min(seen).alias("_seen")).orderBy("_seen", item).limit(n).select(item)


def keep_first_items(df: DataFrame, n: int, item: str = "item_id", seen: str = "date") -> DataFrame:
    """Rows of the first ``n`` distinct items."""
    return attach(df, first_items(df, n, item, seen), [item], how="left_semi", spread_by=[seen])


def trailing_days(df: DataFrame, days: int, column: str = "day_num") -> DataFrame:
    """Rows of the last ``days`` day numbers."""
    latest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) > latest - days)


def sample_rows(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A seeded random sample of ``n`` rows; the top-n sort keeps n rows per task."""
    return df.orderBy(F.rand(seed)).limit(n)
