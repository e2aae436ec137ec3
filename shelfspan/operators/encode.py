"""Category codes and target statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspan.operators.joins import attach
from shelfspan.operators.ordering import code_table
from shelfspan.session import settle


def category_values(df: DataFrame, columns: Sequence[str], missing: str | None = None) -> DataFrame:
    """Distinct ``(column, value)`` rows; ``missing`` names nulls."""
    texts = []
    for c in columns:
        text = F.col(c).cast("string")
        texts.append((F.coalesce(text, F.lit(missing)) if missing else text).alias(c))
    distinct = df.select(*texts).distinct()
    return distinct.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull()).distinct()


def fit_codes(values: DataFrame) -> DataFrame:
    """A stored code table for any number of columns, built in one pass."""
    return settle(code_table(values), "codes")


def apply_codes(
    df: DataFrame, codes: DataFrame, columns: Sequence[str], missing: str | None = None,
    spread_by: Sequence[str] = (), suffix: str = "_encoded",
) -> DataFrame:
    """Join each column's codes; a value without a code gives null."""
    for c in columns:
        own = codes.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("code").cast("int").alias(f"{c}{suffix}")
        )
        text = F.col(c).cast("string")
        keyed = df.withColumn("_value", F.coalesce(text, F.lit(missing)) if missing else text)
        df = attach(keyed, own, ["_value"], spread_by=spread_by, settled=True).drop("_value")
    return df


def apply_codes_or_unknown(df: DataFrame, codes: DataFrame, columns: Sequence[str], spread_by: Sequence[str] = ()) -> DataFrame:
    """Codes for known values; anything else shares one ``unknown`` code.

    The unknown code follows the last known one, or is the code of a fitted
    value that is itself called ``unknown``.
    """
    coded = apply_codes(df, codes, columns, spread_by=spread_by)
    for c in columns:
        own = codes.where(F.col("column") == c)
        unknown = own.agg(
            F.coalesce(F.max(F.when(F.col("value") == "unknown", F.col("code"))), F.max("code") + 1).cast("int")
        ).scalar()
        coded = coded.withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), unknown))
    return coded


def target_statistics(df: DataFrame, column: str, target: str = "demand") -> DataFrame:
    """Mean, sample deviation (0 if undefined) and count of the target per category."""
    return df.groupBy(column).agg(
        F.avg(target).alias(f"{column}_target_mean"),
        F.coalesce(F.stddev_samp(target), F.lit(0.0)).alias(f"{column}_target_std"),
        F.count(target).alias(f"{column}_target_count"),
    )


def add_target_encoding(
    df: DataFrame, columns: Sequence[str], target: str = "demand", fit_on: DataFrame | None = None,
    spread_by: Sequence[str] = ("date",),
) -> DataFrame:
    """Target statistics for several columns, optionally fitted on other rows.

    One pre-aggregation over all columns' combinations feeds every table. The
    deviation merges centred squares, so large targets keep their digits.
    """
    source = df if fit_on is None else fit_on
    value = F.col(target).cast("double")
    parts = settle(
        source.groupBy(*columns).agg(
            F.count(target).alias("_n"), F.avg(value).alias("_m"), (F.var_pop(value) * F.count(target)).alias("_q")
        ),
        "target",
    )
    for c in columns:
        mean, n = f"{c}_target_mean", f"{c}_target_count"
        means = parts.groupBy(c).agg(F.try_divide(F.sum(F.col("_n") * F.col("_m")), F.sum("_n")).alias(mean), F.sum("_n").alias(n))
        away = F.col("_q") + F.col("_n") * F.pow(F.col("_m") - F.col(mean), 2)
        spread = F.try_divide(F.sum(away), F.col(n) - 1)
        centred = attach(parts, means, [c], spread_by=[x for x in columns if x != c])
        stats = centred.groupBy(c, mean, n).agg(
            F.coalesce(F.sqrt(F.when(F.col(n) > 1, spread)), F.lit(0.0)).alias(f"{c}_target_std")
        ).select(c, mean, f"{c}_target_std", n)
        df = attach(df, stats, [c], spread_by=[x for x in spread_by if x != c])
    return df


def past_statistics(df: DataFrame, columns: Sequence[str], target: str = "demand", date: str = "date") -> DataFrame:
    """``column, value, date, past_mean, past_std, past_count`` of every category and day, from strictly earlier days.

    One pass over the rows sums all columns by (column, value, day), map-side
    first; a category then has one row a day, so the running sums behind it
    never see more rows than the calendar has days, however large a category
    is. Sums are of distances to the overall mean, rounded, which keeps the
    digits of the deviation and leaves sums of whole targets exact. A category
    without earlier rows has a null mean, deviation 0 and count 0; null
    categories are one.
    """
    y = F.col(target).cast("double")
    centre = F.coalesce(df.agg(F.round(F.avg(y))).scalar(), F.lit(0.0))
    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    rows = df.select(F.col(date).alias("date"), (y - centre).alias("_y"), sides.alias("_side")).select("date", "_y", "_side.*")
    daily = rows.groupBy("column", "value", "date").agg(F.count("_y").alias("_n"), F.sum("_y").alias("_s"), F.sum(F.col("_y") * F.col("_y")).alias("_q"))
    before = Window.partitionBy("column", "value").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    n, s, q = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("_n", "_s", "_q"))
    summed = daily.select("column", "value", "date", n.alias("n"), s.alias("s"), q.alias("q"))
    away = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
    return summed.select(
        "column", "value", "date",
        F.when(F.col("n") > 0, centre + F.col("s") / F.col("n")).alias("past_mean"),
        F.when(F.col("n") > 1, F.sqrt(away / (F.col("n") - 1))).otherwise(0.0).alias("past_std"),
        F.col("n").alias("past_count"),
    )


def add_past_target_encoding(
    df: DataFrame, columns: Sequence[str], target: str = "demand", date: str = "date", smoothing: float = 0.0, spread_by: Sequence[str] = ("store_id", "item_id"),
) -> DataFrame:
    """Target statistics of several columns as they were known before the row's day.

    ``smoothing`` rows of the overall past mean are added to every mean, so
    rare categories lean on it; without any earlier row both are null.
    """
    marked = df.withColumn("_all", F.lit("all")) if smoothing else df
    table = settle(past_statistics(marked, [*columns, *(["_all"] if smoothing else [])], target, date), "past")
    if smoothing:
        overall = table.where(F.col("column") == "_all").select(F.col("date").alias(date), F.col("past_mean").alias("_overall"))
        df = attach(df, overall, [date], spread_by=[c for c in spread_by if c != date])
    for c in columns:
        names = {f"past_{x}": f"{c}_past_{x}" for x in ("mean", "std", "count")}
        own = table.where(F.col("column") == c).select(F.coalesce("value", F.lit("")).alias("_value"), F.col("value").isNull().alias("_none"), F.col("date").alias(date), *[F.col(a).alias(b) for a, b in names.items()])
        text = F.col(c).cast("string")
        keyed = df.withColumns({"_value": F.coalesce(text, F.lit("")), "_none": text.isNull()})
        df = attach(keyed, own, ["_value", "_none", date], spread_by=[x for x in spread_by if x != c]).drop("_value", "_none")
        if smoothing:
            n = F.col(f"{c}_past_count")
            mixed = (F.coalesce(F.col(f"{c}_past_mean") * n, F.lit(0.0)) + smoothing * F.col("_overall")) / (n + smoothing)
            df = df.withColumn(f"{c}_past_mean", mixed)
    return df.drop("_overall")


def add_past_ratio(df: DataFrame, value: str, by: str, name: str, date: str = "date", spread_by: Sequence[str] = ("store_id", "item_id")) -> DataFrame:
    """A value over the mean that its category had on strictly earlier days; null before it has any or where it is 0."""
    means = past_statistics(df, [by], value, date).where("value is not null").select(F.col("value").alias("_value"), F.col("date").alias(date), F.col("past_mean").alias("_mean"))
    keyed = attach(df.withColumn("_value", F.col(by).cast("string")), means, ["_value", date], spread_by=[c for c in spread_by if c != by])
    return keyed.withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("_mean"))).drop("_value", "_mean")
