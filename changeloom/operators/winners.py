"""Winner of a group, attributes of the winner, and the best-in-group flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.joins import BROADCAST_BYTES, lookup_join


def pick_max(predicate: Column, value: Column | str) -> Column:
    """Largest `value` among the rows where `predicate` holds."""
    return F.max(F.when(predicate, F.col(value) if isinstance(value, str) else value))


def pick_min(predicate: Column, value: Column | str) -> Column:
    """Smallest `value` among the rows where `predicate` holds."""
    return F.min(F.when(predicate, F.col(value) if isinstance(value, str) else value))


def group_winner(
    df: DataFrame,
    group: Sequence[str],
    labels: Sequence[str],
    measures: Mapping[str, str],
    nulls: str = "last",
    pick: str = "column",
) -> DataFrame:
    """Lowest measure per group, with the labels of the row that holds it.

    `df` has one row per (group, entity); `measures` maps a measure column to the
    prefix of its output columns `<prefix>_<label>` and `<prefix>_s`. Among ties
    each label takes its own largest value (`pick="column"`), or all labels come
    from the row with the largest labels (`pick="row"`). With `nulls="first"` a
    missing measure beats any value. One aggregation, no ranking windows.
    """

    def rank(measure: str) -> list[Column]:
        missing = F.col(measure).isNull()
        return [missing if nulls == "first" else ~missing, -F.col(measure)]

    best = []
    for measure, prefix in measures.items():
        if pick == "row":
            best.append(F.max(F.struct(*rank(measure), *labels)).alias(f"_{prefix}"))
        else:
            for label in labels:
                best.append(
                    F.max(F.struct(*rank(measure), label)).alias(f"_{prefix}_{label}")
                )
    out = df.groupBy(*group).agg(*best)
    columns = []
    for measure, prefix in measures.items():
        for label in labels:
            holder = f"_{prefix}" if pick == "row" else f"_{prefix}_{label}"
            columns.append(F.col(holder)[label].alias(f"{prefix}_{label}"))
        columns.append((-F.col(holder)["col2"]).alias(f"{prefix}_s"))
    return out.select(*group, *columns)


def flag_group_minimum(
    df: DataFrame,
    group: Sequence[str],
    measure: str,
    flag: str,
    limit: int = BROADCAST_BYTES,
    work: str | None = None,
) -> DataFrame:
    """True where `measure` equals the smallest of its group; null stays null.

    The group minimum is aggregated map-side and joined on (group, measure), so
    no task has to hold a whole group. With `work`, a shared folder, the minima
    are written there first, and the join is planned on their true size instead
    of an estimate that follows the input.
    """
    best = (
        df.where(F.col(measure).isNotNull())
        .groupBy(*group)
        .agg(F.min(measure).alias(measure))
        .withColumn("_best", F.lit(True))
    )
    if work is not None:
        best.write.parquet(work)
        best = df.sparkSession.read.schema(best.schema).parquet(work)
    joined = lookup_join(df, best, [*group, measure], "left", limit=limit)
    value = F.when(F.col(measure).isNotNull(), F.col("_best").isNotNull())
    return joined.select(*df.columns, value.alias(flag))
