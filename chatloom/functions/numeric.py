"""Exact rounding: half away from zero, in integer or decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to the nearest integer; NULL when the denominator is 0.

    Both are BIGINT and the denominator is not negative, so no value passes
    through floating point.
    """
    half_up = 2 * numerator + F.when(numerator < 0, -denominator).otherwise(denominator)
    return F.call_function("div", half_up, F.nullif(2 * denominator, F.lit(0).cast("bigint")))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between two zone-free timestamps.

    Subtraction keeps the difference zone-free; ``timestampdiff`` would pass
    through the session zone and shift times inside a daylight-saving gap.
    """
    exact = (end - start).cast("interval second").cast("decimal(18,6)")
    return F.round(exact, 0).cast("int")


def minutes(seconds: Column) -> Column:
    """Seconds as minutes with two places."""
    return rounded_ratio(seconds.cast("bigint") * 100, F.lit(60).cast("bigint")) / F.lit(100.0)


def average_minutes(seconds: Column) -> Column:
    """Aggregate: mean of non-NULL seconds as minutes with two places."""
    total = F.sum(seconds.cast("bigint"))
    return rounded_ratio(total * 100, F.count(seconds) * 60) / F.lit(100.0)


def average_minutes_of(total_seconds: Column, measured: Column) -> Column:
    """As ``average_minutes``, from a total and the count of measured rows."""
    return rounded_ratio(total_seconds * 100, measured * 60) / F.lit(100.0)


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with two places; NULL when the whole is 0."""
    return rounded_ratio(part * 10000, whole) / F.lit(100.0)
