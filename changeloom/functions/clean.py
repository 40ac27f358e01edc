"""Cleaning expressions: range guards, normalised text, labels, unit changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(column: str, low=None, high=None) -> Column:
    """The value when low <= value <= high, else null; the row is kept."""
    value = F.col(column)
    kept = F.lit(True)
    if low is not None:
        kept = kept & (value >= low)
    if high is not None:
        kept = kept & (value <= high)
    return F.when(kept, value)


def normal_text(column: str) -> Column:
    return F.upper(F.trim(F.col(column)))


def enum_or_unknown(column: str, allowed: Sequence[str], unknown: str = "UNKNOWN") -> Column:
    """Upper-cased value when it is in the list; anything else, null too, is unknown."""
    value = F.upper(F.col(column))
    return F.when(value.isin(*allowed), value).otherwise(unknown)


def code_label(column: str, labels: Mapping[str, str], unknown: str = "UNKNOWN") -> Column:
    out = F
    for code, label in labels.items():
        out = out.when(F.col(column) == code, label)
    return out.otherwise(unknown)


def not_numeric(column: str) -> Column:
    """True for a present value that is not all digits; a missing one is false."""
    value = F.col(column)
    return value.isNotNull() & ~F.coalesce(value.rlike("^[0-9]+$"), F.lit(False))


def seconds(column: str) -> Column:
    """Milliseconds to seconds as a double."""
    return F.col(column).cast("double") / 1000.0


def race_seq(season: str = "season", round_: str = "round") -> Column:
    """Logical time of a race, whose source has no date: season * 100 + round."""
    return F.col(season) * 100 + F.col(round_)


def seq_season(seq: str) -> Column:
    return F.expr(f"CAST({seq} DIV 100 AS INT)")


def seq_round(seq: str) -> Column:
    return F.expr(f"CAST({seq} % 100 AS INT)")


def elapsed_seconds(start: str, end: Column) -> Column:
    """Whole seconds between two instants, rounded to nearest."""
    micros = F.unix_micros(end) - F.unix_micros(F.col(start))
    return F.round(micros.cast("double") / 1e6).cast("int")


def instant_text(column: str, missing: str = "—") -> Column:
    """Instant as text, a dash when there is none."""
    return F.coalesce(F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss"), F.lit(missing))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
