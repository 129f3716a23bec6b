"""Scalar expressions; all of them stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def model_category(model_id: Column) -> Column:
    """Text before the first dash; the whole text without one; NULL for NULL.

    ``substring_index`` gives the first element of a split without building the
    array of all the others for each row.
    """
    return F.substring_index(model_id, "-", 1)


def revenue_per_unit(revenue: Column, units: Column) -> Column:
    """Ratio as double; NULL where no unit was sold, also under ANSI mode."""
    return F.try_divide(revenue, units)


def day_number(year: Column, month: Column, day: Column) -> Column:
    """A number that grows with the calendar day; NULL if any part is unknown."""
    return year * 10000 + month * 100 + day


def padded(number: Column, width: int) -> Column:
    """Digits with leading zeros up to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
