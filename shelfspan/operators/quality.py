"""Data-quality rules as one aggregate per table.

Every check gives rows ``(dataset, rule, column, violations, severity)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspan.operators.panel import day_columns
from shelfspan.operators.profile import duplicate_keys

# Required columns, bounds and thresholds.
REQUIRED = {
    "sales": ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id"),
    "calendar": ("date", "d", "wm_yr_wk", "weekday", "wday", "month", "year"),
    "prices": ("store_id", "item_id", "wm_yr_wk", "sell_price"),
    "weather": ("date", "state_id", "temp", "humidity"),
    "economic": ("date",),
    "feature_store": ("id", "date", "demand", "item_id", "store_id"),
}
DAY_COLUMNS = 1913
PERIOD = ("2011-01-29", "2016-05-22")
MAX_PRICE = 1000
TEMPERATURE = (-50, 130)
HUMIDITY = (0, 100)
MAX_NULL_SHARE = 0.5
MIN_COMPLETENESS = 90
MAX_MISSING_SHARE = 0.05
SALES_RANGE = (0, 100_000)
REPORT = "dataset string, rule string, column string, violations long, severity string"
RECOMMENDATIONS = {
    "core_data": "Load the core sales, calendar and price tables again",
    "external_data": "Check the weather and economic sources",
    "processed_data": "Build the feature store again after fixing data quality",
}


@dataclass(frozen=True)
class Rule:
    """A named count of violations: an aggregate, or a literal from the schema."""

    rule: str
    column: str
    violations: Column
    severity: str = "error"


def known(condition: Column) -> Column:
    return F.count_if(condition)


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules on columns the table has; an absent column is reported by the rule that requires it."""
    return [r for r in rules if r.column in df.columns]


def _counts(rules: Sequence[Rule]) -> list[Column]:
    return [r.violations.cast("long").alias(f"v{n}") for n, r in enumerate(rules)]


def observe_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """The table with its rules counted by whatever job reads it next, in the same pass.

    Put it last before a write: there a task that runs twice is counted once.
    """
    observation = Observation()
    return df.observe(observation, *_counts(rules)), observation


def observed_report(spark: SparkSession, dataset: str, rules: Sequence[Rule], observation: Observation) -> DataFrame:
    """The rows of ``run_rules`` out of the counts of a finished job."""
    seen = observation.get
    rows = [(dataset, r.rule, r.column, seen[f"v{n}"] or 0, r.severity) for n, r in enumerate(rules)]
    return spark.createDataFrame(rows, REPORT)


def run_rules(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one table in a single aggregate, one row per rule."""
    if not rules:
        return df.sparkSession.createDataFrame([], REPORT)
    row = df.agg(*_counts(rules))
    cells = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"), F.lit(r.rule).alias("rule"), F.lit(r.column).alias("column"),
                F.coalesce(F.col(f"v{n}"), F.lit(0)).alias("violations"), F.lit(r.severity).alias("severity"),
            )
            for n, r in enumerate(rules)
        ]
    )
    return row.select(F.inline(cells))


def required_columns(df: DataFrame, dataset: str) -> list[Rule]:
    return [Rule("required_column", c, F.lit(0 if c in df.columns else 1)) for c in REQUIRED[dataset]]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def sales_rules(df: DataFrame, expected_days: int = DAY_COLUMNS) -> list[Rule]:
    """Wide sales: columns, number and type of days, no negative value."""
    days = day_columns(df)
    rules = required_columns(df, "sales")
    rules.append(Rule("day_columns", "d_*", F.lit(int(len(days) < expected_days)), "warning"))
    for c in days:
        rules.append(Rule("numeric_type", c, F.lit(int(not is_numeric(df, c)))))
        rules.append(Rule("non_negative", c, known(F.col(c).try_cast("double") < 0)))
    return rules


def duplicate_rule(df: DataFrame, dataset: str, column: str = "id") -> DataFrame:
    """Number of values of a key that occur more than once; no row if the key is absent."""
    if column not in df.columns:
        return run_rules(df, dataset, [])
    return run_rules(duplicate_keys(df, [column]), dataset, [Rule("unique", column, F.count(F.lit(1)))])


def calendar_rules(df: DataFrame, period: tuple[str, str] = PERIOD) -> list[Rule]:
    """Calendar: columns, dates that parse, the required period."""
    parsed = F.col("date").cast("string").try_cast("date")
    return [
        *required_columns(df, "calendar"),
        *applicable(df, [
            Rule("date_format", "date", known(F.col("date").isNotNull() & parsed.isNull())),
            Rule("starts_in_time", "date", F.when(F.min(parsed) > F.to_date(F.lit(period[0])), 1).otherwise(0), "warning"),
            Rule("ends_in_time", "date", F.when(F.max(parsed) < F.to_date(F.lit(period[1])), 1).otherwise(0), "warning"),
        ]),
    ]


def gap_rule(gaps: DataFrame, dataset: str = "calendar") -> DataFrame:
    return run_rules(gaps, dataset, [Rule("no_gaps", "date", F.count(F.lit(1)), "warning")])


def price_rules(df: DataFrame, maximum: float = MAX_PRICE) -> list[Rule]:
    """Prices: positive, not extreme, not missing."""
    price = F.col("sell_price")
    return [
        *required_columns(df, "prices"),
        *applicable(df, [
            Rule("positive", "sell_price", known(price <= 0)),
            Rule("not_extreme", "sell_price", known(price > maximum), "warning"),
            Rule("not_null", "sell_price", known(price.isNull()), "warning"),
        ]),
    ]


def weather_rules(df: DataFrame) -> list[Rule]:
    """Weather: plausible temperature and humidity."""
    return [
        *required_columns(df, "weather"),
        *applicable(df, [
            Rule("between", "temp", known(~F.col("temp").between(*TEMPERATURE)), "warning"),
            Rule("between", "humidity", known(~F.col("humidity").between(*HUMIDITY))),
        ]),
    ]


def economic_rules(df: DataFrame, share: float = MAX_NULL_SHARE) -> list[Rule]:
    """Indicators: no numeric column with too many nulls."""
    rules = required_columns(df, "economic")
    for c in df.columns:
        if c != "date" and is_numeric(df, c):
            nulls = known(F.col(c).isNull())
            rules.append(Rule("mostly_known", c, F.when(nulls > F.count(F.lit(1)) * share, 1).otherwise(0), "warning"))
    return rules


def feature_store_rules(df: DataFrame, minimum: float = MIN_COMPLETENESS) -> list[Rule]:
    """Feature store: demand valid, feature families present, columns complete."""
    lag = any("lag_" in c for c in df.columns)
    rolling = any("rolling_" in c for c in df.columns)
    n = F.count(F.lit(1))
    rules = [
        *required_columns(df, "feature_store"),
        *applicable(df, [
            Rule("non_negative", "demand", known(F.col("demand") < 0)),
            Rule("not_null", "demand", known(F.col("demand").isNull()), "warning"),
        ]),
        Rule("lag_features", "*lag_*", F.lit(int(not lag)), "warning"),
        Rule("rolling_features", "*rolling_*", F.lit(int(not rolling)), "warning"),
    ]
    for c in df.columns:
        share = (1 - F.try_divide(known(F.col(c).isNull()).cast("double"), n)) * 100
        rules.append(Rule("complete", c, F.when(share < minimum, 1).otherwise(0), "warning"))
    return rules


def threshold_rules(
    df: DataFrame, column: str = "demand", missing: float = MAX_MISSING_SHARE, values: tuple[float, float] = SALES_RANGE
) -> list[Rule]:
    """Configured limits: share of missing values, smallest and largest sale."""
    c = F.col(column)
    nulls = known(c.isNull())
    return applicable(df, [
        Rule("max_missing", column, F.when(nulls > F.count(F.lit(1)) * missing, 1).otherwise(0), "warning"),
        Rule("min_value", column, known(c < values[0])),
        Rule("max_value", column, known(c > values[1])),
    ])


def expectations(df: DataFrame, dataset: str) -> list[Rule]:
    """Expectation suites for the sales and weather tables."""

    def exists(column):
        return Rule("exists", column, F.lit(int(column not in df.columns)))

    if dataset == "sales":
        return [
            exists("demand"),
            *applicable(df, [Rule("between", "demand", known(F.col("demand") < 0))]),
            exists("date"),
            *applicable(df, [Rule("not_null", "id", known(F.col("id").isNull()))]),
        ]
    if dataset == "weather":
        between = [Rule("between", c, known(~F.col(c).between(*bounds))) for c, bounds in (("temp", TEMPERATURE), ("humidity", HUMIDITY))]
        return [exists("temp"), *applicable(df, between)]
    return []


def suite_result(checked: DataFrame) -> DataFrame:
    """Per dataset: number of expectations, of failures, and success."""
    failed = F.count_if(F.col("violations") > 0)
    return checked.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("expectations"), failed.alias("failed"), (failed == 0).cast("int").alias("success")
    )


def quality_report(checked: DataFrame, families: dict[str, Sequence[str]]) -> DataFrame:
    """Passed families, success rate, status and recommendations as one row."""
    family = F.lit(None).cast("string")
    for name, datasets in families.items():
        family = F.when(F.col("dataset").isin(*datasets), name).otherwise(family)
    issues = checked.groupBy(family.alias("family")).agg(F.count_if(F.col("violations") > 0).alias("issues"))
    passed = F.count_if(F.col("issues") == 0)
    total = F.count(F.lit(1))
    advice = F.lit(None).cast("string")
    for name, text in RECOMMENDATIONS.items():
        advice = F.when((F.col("family") == name) & (F.col("issues") > 0), text).otherwise(advice)
    return issues.agg(
        total.alias("total_checks"), passed.alias("passed_checks"), (F.try_divide(passed, total) * 100).alias("success_rate"),
        F.when(passed == total, "PASS").otherwise("FAIL").alias("overall_status"),
        F.concat_ws("; ", F.array_sort(F.collect_list(advice))).alias("recommendations"),
    )
