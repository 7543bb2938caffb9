"""Rounding, clamping and lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null: least() and greatest() alone would skip it."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def at_most(value: Column, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.lit(high), value))


def settled_round(value: Column, digits: int) -> Column:
    """Round a result of sums whose order is not fixed.

    The inner rounding removes the last-digit noise of summation order, so that a value that
    should sit exactly on a rounding edge goes the same way on every run.
    """
    return F.round(F.round(value, 10), digits)


def number_or_zero(value: Column) -> Column:
    """Any column as a double; text that is no number, null and NaN become 0."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), 0.0).otherwise(number)


def unit_interval(value: Column) -> Column:
    return clamp(number_or_zero(value), 0.0, 1.0)


def is_true(value: Column) -> Column:
    """True for a true boolean and for the texts TRUE and 1 in any case; null is false."""
    return F.coalesce(F.upper(value.cast("string")).isin("TRUE", "1"), F.lit(False))


def plant_label(plant_id: Column) -> Column:
    return F.initcap(F.replace(plant_id, F.lit("_"), F.lit(" ")))
