"""Refresh only what changed: affected groups, scoped inputs, replaced groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.joins import BROADCAST_BYTES, lookup_join


def affected_groups(changes: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Groups named by any of the change sets, deletes included."""
    keyed = [c.select(*on) for c in changes]
    return reduce(lambda a, b: a.unionByName(b), keyed).distinct()


def split_by_null(df: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose group is complete, and rows with a null in it."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return df.where(known), df.where(~known)


def match_groups(
    df: DataFrame, affected: DataFrame, on: Sequence[str], how: str, limit: int, stored: bool = True
) -> DataFrame:
    """Semi or anti join on groups in which null equals null.

    In a table that is `stored` in folders of its groups, complete groups join on plain equality with
    a predicate on the counted groups: that is what lets Spark prune the folders to them. Groups
    with a null, folders of their own, are joined apart. Rows that are computed would be computed
    twice that way; their groups are compared as structs, in which nulls are equal.
    """
    on = list(on)
    if not stored:
        groups = affected.select(F.struct(*on).alias("_group")).distinct()
        return lookup_join(df.withColumn("_group", F.struct(*on)), groups, ["_group"], how, limit=limit).drop("_group")
    counted = affected.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0").select(*on)
    rows, odd_rows = split_by_null(df, on)
    groups, odd_groups = split_by_null(counted, on)
    joined = lookup_join(rows, groups, on, how, limit=limit)
    renamed = odd_groups.withColumnsRenamed({c: f"_g_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in on])
    return joined.unionByName(odd_rows.join(renamed, same, how))


def scope_to(
    df: DataFrame, affected: DataFrame, on: Sequence[str], limit: int = BROADCAST_BYTES, stored: bool = True
) -> DataFrame:
    """Rows of `df` in an affected group (semi-join on the typed columns; null equals null)."""
    return match_groups(df, affected.select(*on), on, "left_semi", limit, stored)


def replace_groups(
    old: DataFrame,
    affected: DataFrame,
    recomputed: DataFrame,
    on: Sequence[str],
    limit: int = BROADCAST_BYTES,
    stored: bool = True,
) -> DataFrame:
    """`old` with every affected group replaced by its recomputed rows.

    A group that no longer has input rows disappears.
    """
    kept = match_groups(old, affected.select(*on), on, "left_anti", limit, stored)
    return kept.unionByName(recomputed, allowMissingColumns=True)
