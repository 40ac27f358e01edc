"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when Spark's own estimate of it is below this.
BROADCAST_BYTES = 10 * 1024 * 1024
# A key is hot when it holds more than 1/HOT_SHARE of the left rows, so there
# are always fewer than HOT_SHARE hot keys and their list can be broadcast.
HOT_SHARE = 1000
SALTS = 64


def estimated_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate of a plan, or None where it cannot be asked."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys with more than 1/share of the rows; fewer than `share` of them."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * share > total).select(*on)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    residual: Column | None = None,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join a large left side to a lookup (left, inner, left_semi, left_anti).

    A lookup whose estimated size is below `limit` is broadcast, so the left
    side is not shuffled. Otherwise both sides are shuffled and the hot keys of
    the left side are spread over `salts` partitions, with the matching lookup
    rows copied to each; rows with a null key, which match nothing, are spread
    too. `residual` is an extra condition over columns of both sides. Hot keys are
    counted in `keys_from` where the left side is costly to compute twice.
    """
    on = list(on)
    if fits_broadcast(right, limit):
        return _join(left, F.broadcast(right), on, how, residual)

    hot = hot_keys(left if keys_from is None else keys_from, on).withColumn("_hot", F.lit(True))
    has_null = F.lit(False)
    for c in on:
        has_null = has_null | F.col(c).isNull()
    # Same row, same salt on a retried task; equal rows of different input
    # partitions still land apart.
    hashed = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(salts)).cast("int")
    salted_left = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.when(F.col("_hot") | has_null, spread).otherwise(F.lit(0)))
        .drop("_hot")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_right = (
        right.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return _join(salted_left, salted_right, [*on, "_salt"], how, residual).drop("_salt")


def _join(left, right, on, how, residual):
    if residual is None:
        return left.join(right, on, how)
    # Name the right side's keys apart so that a residual can be added.
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = residual
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def slices_per_version(newest: int | None, lowest: int | None, chunk: int) -> int:
    """Most slices that one version can be copied to; Spark's estimate ignores those copies."""
    if newest is None or lowest is None:
        return 1
    return int(newest) // chunk - int(lowest) // chunk + 1


def point_in_time_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    seq: str,
    valid_from: str,
    valid_to: str,
    chunk: int = 1024,
    limit: int = BROADCAST_BYTES,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join each fact to the version valid at its `seq` (bounds inclusive).

    Versions of a key must not overlap; a null `valid_to` is open. Where all copies fit, the
    versions are broadcast, keyed by the `chunk`-wide slices of the sequence they touch and cut to the
    span of the facts before. Otherwise facts and versions go through one shuffle and
    no version is copied (`scan.asof_join`). Span and hot keys are read from `keys_from` where the
    facts are costly to compute.
    """
    from changeloom.operators.scan import asof_join

    spanned = facts if keys_from is None else keys_from
    lowest, newest = spanned.agg(F.min(seq), F.max(seq)).first()
    if not fits_broadcast(dim, limit // slices_per_version(newest, lowest, chunk)):
        return asof_join(facts, dim, on, seq, valid_from, valid_to, keys_from)
    kind = spanned.schema[seq].dataType
    first = F.greatest(F.col(valid_from), F.lit(lowest).cast(kind))
    last = F.least(F.col(valid_to), F.lit(newest).cast(kind))

    def slice_of(position: Column) -> Column:
        return F.floor(position / chunk).cast("long")

    sliced = dim.where(first <= last).withColumn(
        "_chunk", F.explode(F.sequence(slice_of(first), slice_of(last)))
    )
    valid = (F.col(seq) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(seq) <= F.col(valid_to)))
    numbered = facts.withColumn("_chunk", slice_of(F.col(seq)))
    return _join(numbered, F.broadcast(sliced), [*on, "_chunk"], "left", valid).drop("_chunk")
