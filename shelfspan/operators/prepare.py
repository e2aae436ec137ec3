"""From feature table to model matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import RobustScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspan.functions.scalar import finite
from shelfspan.operators.encode import apply_codes, category_values, fit_codes
from shelfspan.operators.ordering import exact_percentiles

# Columns that never enter the model matrix.
EXCLUDED = (
    "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "date", "demand", "wm_yr_wk", "weekday",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2", "state_cat", "store_cat", "store_dept",
)

# Name fragments of the feature groups.
GROUPS = {
    "temporal": ("month", "day", "year", "week", "sin", "cos"),
    "lag": ("lag_",),
    "rolling": ("rolling_", "ewm_"),
    "price": ("price", "discount"),
    "demand_patterns": ("intermittency", "intensity", "velocity"),
    "categorical": ("encoded",),
    "business": ("performance", "competition", "age"),
    "events": ("event", "snap", "holiday"),
}


def feature_columns(df: DataFrame, exclude: Sequence[str] = EXCLUDED) -> list[str]:
    """Columns that are not identifiers, target or split labels."""
    return [c for c in df.columns if c not in {*exclude, "split", "fold", "role"}]


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """Feature names by group; one name may belong to several groups."""
    return {group: [c for c in columns if any(x in c for x in parts)] for group, parts in GROUPS.items()}


def numeric_matrix(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), spread_by: Sequence[str] = ()) -> DataFrame:
    """Numbers as they are, numeric text cast, other text coded alphabetically.

    A text column counts as numeric when every known value casts; that is
    decided in one pass over all text columns.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    texts = [c for c in columns if isinstance(kinds[c], T.StringType)]
    coded = []
    if texts:
        bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in texts])
        counts = bad.first().asDict()
        coded = [c for c in texts if counts[c]]
    if coded:
        codes = fit_codes(category_values(df, coded))
        df = apply_codes(df, codes, coded, spread_by=spread_by)
    out = []
    for c in columns:
        if c in coded:
            out.append(F.col(f"{c}_encoded").cast("double").alias(c))
        elif c in texts:
            out.append(F.col(c).try_cast("double").alias(c))
        elif isinstance(kinds[c], T.BooleanType):
            out.append(F.col(c).cast("int").cast("double").alias(c))
        else:
            out.append(finite(F.col(c).cast("double")).alias(c))
    return df.select(*keep, *out)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact column medians as rows ``(column, median)``."""
    return exact_percentiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))


def impute(df: DataFrame, columns: Sequence[str], medians: DataFrame) -> DataFrame:
    """Known value, else the fitted median, else 0.

    The fitted table has one row per column, so it is read like model parameters.
    """
    fitted = {row["column"]: row["median"] for row in medians.collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fitted.get(c)), F.lit(0.0)) for c in columns})


def as_float(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


def align_columns(df: DataFrame, fitted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the fitted columns: missing ones become 0, extra ones go."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0.0).alias(c) for c in fitted])


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def robust_scaler(source: str = "features", output: str = "scaled") -> RobustScaler:
    """Median and interquartile scaling."""
    return RobustScaler(inputCol=source, outputCol=output, withCentering=True, withScaling=True)


def robust_scale(df: DataFrame, columns: Sequence[str], by_rows: DataFrame | None = None) -> DataFrame:
    """Columns less their exact median, over their exact interquartile range; a range of 0 counts as 1.

    ``by_rows`` are the rows the statistics come from. Nulls stay null.
    """
    fitted = exact_percentiles(df if by_rows is None else by_rows, columns, [0.25, 0.5, 0.75]).collect()
    known = {(r["column"], r["p"]): r["value"] for r in fitted}
    scaled = {}
    for c in columns:
        low, middle, high = (known.get((c, p), 0.0) for p in (0.25, 0.5, 0.75))
        scaled[c] = (F.col(c).cast("double") - F.lit(middle)) / F.lit((high - low) or 1.0)
    return df.withColumns(scaled)
