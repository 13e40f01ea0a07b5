"""Missing-value rules and rounding of the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlake.schema import SENTINEL, Metric


def missing_to_sentinel(metric: Metric, raw: Column, value: Column) -> Column:
    """The sentinel for an absent value, else the parsed value.

    Text that is present but unreadable is not absent: it stays NULL. So do NaN, which Spark orders
    above every number, and the infinities, which would each spoil the sums of a whole group.
    """
    infinity = float("inf")
    missing = raw.isNull() | (value == SENTINEL)
    if metric.negative_is_missing:
        missing = missing | ((value < 0) & (value > -infinity))
    return F.when(missing, F.lit(float(SENTINEL))).when(F.abs(value) < infinity, value)


def is_valid(metric: Metric) -> Column:
    return F.col(metric.column) != F.lit(SENTINEL)


def zero_filled(metric: Metric) -> Column:
    """Invalid and NULL values count as 0, so they weigh on AVG, MIN and MAX."""
    return F.when(is_valid(metric), F.col(metric.column)).otherwise(F.lit(0))


def round_cents(value: Column) -> Column:
    """Two decimals, half up on the decimal value, so the result does not hang on the last binary
    digits of a sum. Only values less than 5e-13 below a tie differ from rounding the double itself. A double
    too large for the decimal holds no fraction and is kept as it is."""
    return F.coalesce(F.round(value.try_cast("decimal(38,12)"), 2).cast("double"), value)
