"""Scalar expressions: calendar parts, guarded arithmetic, bins and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def date_parts(date: str = "date") -> dict[str, Column]:
    """Year, month, day, weekday (Monday = 0), day of year, ISO week, quarter."""
    c = F.col(date)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "dayofweek": F.weekday(c),
        "dayofyear": F.dayofyear(c),
        "week": F.weekofyear(c),
        "quarter": F.quarter(c),
    }


def weekend(date: str = "date") -> Column:
    return flag(F.weekday(F.col(date)).isin(5, 6))


def period_edges(date: str = "date") -> dict[str, Column]:
    """True first and last days of month, quarter and year."""
    c = F.col(date)
    edges = {}
    for name, unit, months in (("month", "MM", 1), ("quarter", "Q", 3), ("year", "YYYY", 12)):
        first = F.trunc(c, unit) if unit != "Q" else F.to_date(F.date_trunc("quarter", c))
        edges[f"is_{name}_start"] = flag(c == first)
        edges[f"is_{name}_end"] = flag(c == F.date_sub(F.add_months(first, months), 1))
    return edges


def near_month_edges(day: Column) -> dict[str, Column]:
    """Approximate month edges: the first three days, and the 28th onwards."""
    return {"is_month_start": flag(day <= 3), "is_month_end": flag(day >= 28)}


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of the given period."""
    angle = 2 * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def month_period(date: str = "date") -> Column:
    """First day of the month, used as a monthly join key."""
    return F.trunc(F.col(date), "MM")


def holiday_windows() -> dict[str, Column]:
    """Fixed-date holiday windows over month, day and weekday columns."""
    month, day, weekday = F.col("month"), F.col("day"), F.col("dayofweek")
    return {
        "is_christmas_week": flag((month == 12) & (day >= 22)),
        "is_thanksgiving_week": flag((month == 11) & day.between(22, 28)),
        "is_new_year_week": flag((month == 1) & (day <= 7)),
        "is_memorial_day": flag((month == 5) & (weekday == 0) & (day >= 25)),
        "is_labor_day": flag((month == 9) & (weekday == 0) & (day <= 7)),
    }


def event_flags() -> dict[str, Column]:
    """Presence of the first and second event, and of either."""
    one, two = F.col("event_name_1").isNotNull(), F.col("event_name_2").isNotNull()
    return {"has_event_1": flag(one), "has_event_2": flag(two), "has_any_event": flag(one | two)}


def snap_flags(columns: Sequence[str]) -> dict[str, Column]:
    """Number of active assistance programmes on a day, and whether any is."""
    total = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in columns), F.lit(0))
    return {"snap_total": total, "has_snap": flag(total > 0)}


def binned(value: Column, edges: Sequence[Column | float], labels: Sequence[str]) -> Column:
    """Right-closed bins with the given inner edges; nulls stay null."""
    chain = F.when(value.isNull(), None)
    for edge, label in zip(edges, labels[:-1]):
        bound = edge if isinstance(edge, Column) else F.lit(float(edge))
        chain = chain.when(value <= bound, label)
    return chain.otherwise(labels[-1])


def bin_number(value: Column, low: Column, width: Column, bins: int) -> Column:
    """Zero-based left-closed equal-width bin; the maximum joins the last bin."""
    position = F.floor(F.coalesce(ratio(value - low, width), F.lit(0.0)))
    return F.when(value.isNull(), None).otherwise(F.least(F.greatest(position, F.lit(0)), F.lit(bins - 1)))


def joined_text(*columns: str) -> Column:
    """Columns as text, separated by an underscore."""
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])


def finite(value: Column) -> Column:
    """Null for infinities and NaN."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)
