"""Typed values from raw frames, where a missing number is NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(value: Column, kind: T.DataType) -> Column:
    """Null for null and NaN."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def as_int(value: Column, kind: T.DataType) -> Column:
    return present(value, kind).cast("int")


def as_float(value: Column, kind: T.DataType) -> Column:
    return present(value, kind).cast("float")


def as_bool(value: Column, kind: T.DataType) -> Column:
    return present(value, kind).cast("boolean")


def as_text(value: Column, kind: T.DataType) -> Column:
    return present(value, kind).cast("string")


def as_millis(value: Column, kind: T.DataType) -> Column:
    """Whole milliseconds of an interval, cut towards zero in double arithmetic."""
    if not isinstance(kind, T.DayTimeIntervalType):
        return F.lit(None).cast("long")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.unix_micros((epoch + value).cast("timestamp"))
    return (micros.cast("double") / 1e6 * 1000).cast("long")


def as_instant(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(None).cast("timestamp")
    return value.cast("timestamp")
