"""Expectations on a table, as queries that return the failures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple


@dataclass(frozen=True)
class Grain:
    columns: tuple


Rule = NotNull | Unique | Accepted | Grain


class ExpectationFailed(RuntimeError):
    """A table broke one of its rules and must not be published."""


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where("_rows > 1").withColumnRenamed("_rows", count)


def unexpected_values(
    df: DataFrame, column: str, values: Sequence, count: str = "n"
) -> DataFrame:
    """Values outside the accepted list, with their row count; null is accepted."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column: one pass over the table for all of them."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


def check(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: rule, column, failures (0 when it holds)."""
    rules = list(rules)
    parts = []
    required = [r.column for r in rules if isinstance(r, NotNull)]
    if required:
        parts.append(
            null_counts(df, required).select(
                F.lit("not_null").alias("rule"), "column", "failures"
            )
        )
    for rule in rules:
        if isinstance(rule, Unique):
            values = df.where(F.col(rule.column).isNotNull())
            failed, label, name = duplicate_keys(values, [rule.column]), "unique", rule.column
        elif isinstance(rule, Accepted):
            failed = unexpected_values(df, rule.column, rule.values)
            label, name = "accepted_values", rule.column
        elif isinstance(rule, Grain):
            failed = duplicate_keys(df, rule.columns)
            label, name = "grain", ",".join(rule.columns)
        else:
            continue
        parts.append(
            failed.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(label).alias("rule"), F.lit(name).alias("column"), "failures"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def expect(df: DataFrame, rules: Iterable[Rule], table: str = "table") -> None:
    """Raise when a rule fails; the result has one row per rule."""
    rules = list(rules)
    if not rules:
        return
    broken = check(df, rules).where("failures > 0").collect()
    if broken:
        listed = "; ".join(f"{r['rule']}({r['column']}): {r['failures']}" for r in broken)
        raise ExpectationFailed(f"{table}: {listed}")
