"""Slowly changing dimensions (type 2) derived from observed attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.ordered import neighbours

# Fixed value: upper bound of the version that is still valid, in the models.
OPEN_END = 999999


def one_row_per_seq(
    df: DataFrame,
    key: str,
    seq: str,
    attrs: Sequence[str],
    preference: Sequence[str],
) -> DataFrame:
    """Keep one attribute set per (key, seq): the one with the highest `preference`.

    An aggregation, so a hot (key, seq) is reduced before the shuffle.
    """
    picked = F.max(F.struct(*preference, *attrs)).alias("_picked")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key, seq)
        .agg(picked)
        .select(key, seq, *[F.col("_picked")[a].alias(a) for a in attrs])
    )


def scd2_islands(
    observed: DataFrame,
    key: str,
    seq: str,
    attrs: Sequence[str],
    open_end: int | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Versions of `attrs` per key from one observation per (key, seq).

    Consecutive equal observations form one version. Columns added:
    `_valid_from_seq`, `_valid_to_seq_observed` (last observation),
    `_valid_to_seq_excl` (next start - 1, inclusive; `open_end`, null by default,
    when current) and `is_current`.

    A window holds the rows of one key; `chunk` bounds it where a key has many.
    """
    around = neighbours(observed, [key], seq, attrs, chunk)

    def differs(side: str):
        changed = F.col(side).isNull()
        for a in attrs:
            changed = changed | ~F.col(a).eqNullSafe(F.col(side)[a])
        return changed

    # Only the first and last observation of a version are kept, then paired.
    edges = (
        around.withColumns(
            {
                "_starts": differs("_prev"),
                "_ends": differs("_next"),
                "_next_start": F.col("_next")[seq],
            }
        )
        .where("_starts OR _ends")
        .select(key, seq, *attrs, "_starts", "_ends", "_next_start")
    )
    paired = neighbours(edges, [key], seq, ["_next_start"], chunk).where("_starts")
    until = F.when(F.col("_ends"), F.col(seq)).otherwise(F.col("_next")[seq])
    following = F.when(F.col("_ends"), F.col("_next_start")).otherwise(
        F.col("_next")["_next_start"]
    )
    return paired.select(
        key,
        *attrs,
        F.col(seq).alias("_valid_from_seq"),
        until.alias("_valid_to_seq_observed"),
        F.coalesce(following - 1, F.lit(open_end).cast(observed.schema[seq].dataType)).alias("_valid_to_seq_excl"),
        following.isNull().alias("is_current"),
    )
