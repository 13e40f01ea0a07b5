"""Text to typed value. Every conversion gives NULL for text it cannot read, whatever the
session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(name: str) -> Column:
    return F.col(name).try_cast("double")


# Exclusive bounds: a fraction is dropped before the value has to fit.
_INTEGER_BOUNDS = {"smallint": (-32769, 32768), "int": (-2147483649, 2147483648)}


def whole_number(value: Column, to: str) -> Column:
    """Double to integer type, dropping the fraction; NULL when it does not fit. The bounds are
    tested first, since a failing cast raises and catches an exception for every such row."""
    low, high = _INTEGER_BOUNDS[to]
    return F.when((value > low) & (value < high), value.try_cast(to))


def wall_clock(name: str) -> Column:
    """Date and time as written, tied to no zone."""
    return F.col(name).try_cast("timestamp_ntz")
