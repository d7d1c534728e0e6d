"""Column helpers. All of them are built-in expressions and stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_between_starts(start: Column, end: Column) -> Column:
    """Whole calendar months from start to end, days of the month ignored."""
    years = F.year(end) - F.year(start)
    months = F.month(end) - F.month(start)
    return (years * 12 + months).cast("bigint")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def iso_date(day: Column) -> Column:
    """ISO text of a date; a cast, because date_format would pass through the session zone."""
    return day.cast("string")


def iso_seconds(moment: Column) -> Column:
    """ISO text of a zone-free timestamp, to the second."""
    return F.substring(moment.cast("string"), 1, 19)


def to_cents(price: Column) -> Column:
    """Money as whole cents: long sums are exact, order-free and codegen-cheap.

    rint works on the primitive; round would build a BigDecimal for every row.
    """
    return F.rint(price.cast("double") * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents / F.lit(100.0)


def at_least(value: Column, floor) -> Column:
    return F.greatest(value, F.lit(floor))


def between_bounds(value: Column, low: float, high: float) -> Column:
    """Clamp; null stays null (greatest and least would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def ratio_or(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def smoothed_ratio(numerator: Column, denominator: Column) -> Column:
    """Add-one smoothing keeps the ratio finite when a window is empty."""
    return (numerator + 1).cast("double") / (denominator + 1).cast("double")


def finite_or_zero(value: Column) -> Column:
    unusable = F.isnan(value) | value.isNull() | (F.abs(value) == float("inf"))
    return F.when(unusable, 0.0).otherwise(value)
