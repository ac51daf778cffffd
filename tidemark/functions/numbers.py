"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_number(text: Column) -> Column:
    """Text to DOUBLE; null when the text is not a decimal number.

    Java also reads ``12d``, ``12f`` and hexadecimal floats as numbers; those stay text here.
    """
    return F.when(~text.rlike("[dDfFxX]"), text.try_cast("double"))


def range_or_fill(value: Column, low: float, high: float, fill: float = 0.0) -> Column:
    """``value`` when it lies in [low, high], else ``fill``; null and NaN also become ``fill``."""
    return F.when(value.between(low, high), value).otherwise(F.lit(fill))


def round2(value: Column) -> Column:
    """Two decimals, ties to even.

    The hundredfold value is first snapped to six decimals, so the last bit of a mean, which
    depends on the order of addition, cannot change the result.
    """
    return F.rint(F.round(value * 100, 6)) / 100


def completeness(actual: Column, expected: Column) -> Column:
    """actual / expected with four decimals; null when expected is 0 or null."""
    return F.bround(actual / F.nullif(expected, F.lit(0)), 4)
