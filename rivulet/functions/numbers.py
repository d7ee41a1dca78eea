"""Column functions over numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: one foot per second in miles per hour.
FEET_PER_SECOND_IN_MPH = 0.681818


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Straight-line distance of two points."""
    dx, dy = ax - bx, ay - by
    return F.sqrt(dx * dx + dy * dy)


def to_mph(feet_per_second: Column) -> Column:
    return feet_per_second * F.lit(FEET_PER_SECOND_IN_MPH)


def square(value: Column) -> Column:
    return value * value


def nearest(value: Column) -> Column:
    """Nearest whole number, halves upward."""
    return F.floor(value + 0.5)


def scaled(value: Column, low: Column, high: Column) -> Column:
    """``value`` mapped to 0..1 between ``low`` and ``high``; null when they coincide."""
    return F.try_divide(value - low, high - low)
