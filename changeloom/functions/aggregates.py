"""Aggregates whose result does not depend on how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_seconds(millis_sum: Column | str, count: Column | str) -> Column:
    """Mean in seconds from an exact integer sum of milliseconds."""
    total = F.col(millis_sum) if isinstance(millis_sum, str) else millis_sum
    n = F.col(count) if isinstance(count, str) else count
    return F.when(n > 0, total.cast("double") / (n * 1000.0))


def squared(millis: str) -> Column:
    """Square of whole milliseconds, wide enough to be summed exactly."""
    value = F.col(millis).cast("long")
    return (value * value).cast("decimal(28,0)")


def stddev_seconds(count: str, millis_sum: str, squares_sum: str) -> Column:
    """Sample deviation in seconds over groups with (count, sum, sum of squares) of milliseconds.

    n * sum(x^2) - sum(x)^2 is an exact integer, so close values do not cancel. The types hold
    10^12 laps of up to an hour in one group.
    """
    n = F.sum(count).cast("decimal(12,0)")
    total = F.sum(millis_sum).cast("decimal(19,0)")
    spread = n * F.sum(squares_sum).cast("decimal(26,0)") - total * total
    rows = F.sum(count).cast("double")
    return F.when(rows > 1, F.sqrt(spread.cast("double") / (rows * (rows - 1))) / 1000.0)
