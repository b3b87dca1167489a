"""Numeric expressions shared by reports and models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(column: Column) -> Column:
    """NULL or NaN. Text that is no number is not missing."""
    return column.isNull() | F.coalesce(F.isnan(column.try_cast("double")), F.lit(False))


def number(column: Column) -> Column:
    """The column as double; text that is no number, and NaN, become NULL."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def squared(value: Column) -> Column:
    return value * value


def percent_difference(value: Column, base: Column) -> Column:
    """How far ``value`` lies above ``base``, in percent; NULL for a zero base."""
    return F.try_divide(value - base, base) * 100


def fixed_width_bin(value: Column, width: float, scale: int = 100) -> Column:
    """Index of the fixed-width bin that holds ``value`` (bigint).

    Values are first brought to whole units of ``1/scale`` so that a value on a
    bin edge is never moved by binary rounding. ``width`` must be a whole number
    of those units.
    """
    units = round(width * scale)
    if units <= 0 or abs(units - width * scale) > 1e-9:
        raise ValueError(f"bin width {width} is not a positive multiple of 1/{scale}")
    return F.floor(F.round(value * scale).cast("bigint") / F.lit(units))
