"""Ordered scans over keys of any size: running sums and as-of joins in two levels.

A key with more than 1/HOT_SHARE of the rows is hot, so there are fewer than HOT_SHARE of
them. Each is cut into PARTS slices at quantiles of its sequence; every other key is one slice. A
window runs over the rows of one slice, and one summary row per slice carries what
came before it. No window holds a hot key, no row is copied, and the bounds
of the slices, PARTS numbers for each hot key, are all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeloom.operators.joins import HOT_SHARE, hot_keys

# Slices of a hot key.
PARTS = 64
# Columns a scan adds on the way: place of the slice in its key, and of a share of a crowded moment.
SLICE, SHARE = "_slice", "_share"


def slice_bounds(df: DataFrame, keys: Sequence[str], seq: str, parts: int = PARTS) -> DataFrame:
    """(keys, _bounds, _crowded) of the hot keys: upper ends of their slices, and ends that fill several.

    Quantiles are approximate, so they are taken once and kept as rows.
    """
    keys = list(keys)
    known = df.select(*keys, seq).where(F.col(seq).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    hot = hot_keys(known, keys)
    cuts = F.percentile_approx(seq, [i / parts for i in range(1, parts)], F.lit(100 * parts))
    found = known.join(F.broadcast(hot), keys, "left_semi").groupBy(*keys).agg(cuts.alias("_bounds"))
    shape = T.StructType(
        [*[df.schema[k] for k in keys], *[T.StructField(c, T.ArrayType(df.schema[seq].dataType)) for c in ("_bounds", "_crowded")]]
    )
    rows = []
    for row in found.collect():
        bounds = list(row["_bounds"])
        rows.append((*[row[k] for k in keys], sorted(set(bounds)), sorted({b for b in bounds if bounds.count(b) > 1})))
    return df.sparkSession.createDataFrame(rows, shape)


def sliced(df: DataFrame, bounds: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Add the slice of every row; rows at a moment that fills several slices are the last of theirs."""
    cut = F.size(F.filter("_bounds", lambda b: b < F.col(seq)))
    known = df.join(F.broadcast(bounds), list(keys), "left")
    crowded = F.coalesce(F.array_contains("_crowded", F.col(seq)), F.lit(False))
    return (
        known.withColumn(SLICE, F.when(F.col("_bounds").isNull(), 0).otherwise(cut))
        .withColumn("_is_crowded", crowded)
        .drop("_bounds", "_crowded")
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], seq: str, value: str, out: str, parts: int = PARTS
) -> DataFrame:
    """Add `out`: the sum of `value` over the rows of the key up to and with this one.

    Expects one row per (keys, seq) with a sequence that is not null; integers and decimals add
    up exactly whatever the slices. Nulls in `value` count as nothing. A null key is a key
    like any other, but is not cut.
    """
    keys = list(keys)
    bounds = slice_bounds(df, keys, seq, parts)
    rows = sliced(df, bounds, keys, seq).drop("_is_crowded")
    inside = Window.partitionBy(*keys, SLICE).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, SLICE).agg(F.sum(value).alias("_total"))
    offsets = totals.select(*[F.col(k).alias(f"_o_{k}") for k in (*keys, SLICE)], F.sum("_total").over(before).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in (*keys, SLICE)]
    summed = rows.withColumn("_inside", F.sum(value).over(inside)).join(offsets, same, "left")
    total = F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return summed.select(*df.columns, total.cast(totals.schema["_total"].dataType).alias(out))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    seq: str,
    valid_from: str,
    valid_to: str,
    keys_from: DataFrame | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """Left join each fact to the version of its key that is valid at `seq` (bounds inclusive).

    Versions of a key must not overlap; a null `valid_to` is open. Versions and facts go
    through one shuffle as one ordered stream; the last version that started before a slice is
    carried into it by a summary row. Facts of one key that share a moment with many others
    get slices of their own behind the versions that start by then. Facts with a null key or
    sequence find nothing, versions with a null key or start are never found. Hot keys are
    taken from `keys_from` where the facts are costly to compute twice.
    """
    on = list(on)
    attrs = [c for c in versions.columns if c not in on]
    bounds = slice_bounds(facts if keys_from is None else keys_from, on, seq, parts)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(on)]
    known = versions.where(F.col(valid_from).isNotNull())
    for k in on:
        known = known.where(F.col(k).isNotNull())
    starts = sliced(known, bounds, on, valid_from).select(
        *named, SLICE, F.lit(0).alias(SHARE), F.col(valid_from).alias("_at"), F.struct(*attrs).alias("_version")
    )
    # The same row gets the same share in a repeated task; equal rows of other input splits another.
    hashed = [f.name for f in facts.schema.fields if "map<" not in f.dataType.simpleString()]
    share = 1 + F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(parts))
    asked = sliced(facts, bounds, on, seq).select(
        *named,
        SLICE,
        F.when(F.col("_is_crowded"), share).otherwise(0).cast("int").alias(SHARE),
        F.col(seq).alias("_at"),
        F.struct(*facts.columns).alias("_fact"),
    )
    keys = [f"_k{i}" for i in range(len(on))]
    stream = starts.unionByName(asked, allowMissingColumns=True)
    inside = (
        Window.partitionBy(*keys, SLICE, SHARE)
        .orderBy(F.col("_at").asc_nulls_first(), F.col("_version").isNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = stream.withColumn("_inside", F.last("_version", ignorenulls=True).over(inside)).where(F.col("_fact").isNotNull())
    # Slices of facts are only counted, those of versions keep their last one.
    last = starts.groupBy(*keys, SLICE, SHARE).agg(F.max_by("_version", "_at").alias("_last"))
    slices = asked.select(*keys, SLICE, SHARE).distinct().join(last, [*keys, SLICE, SHARE], "full")
    before = Window.partitionBy(*keys).orderBy(SLICE, SHARE).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*keys, SLICE, SHARE, F.last("_last", ignorenulls=True).over(before).alias("_before"))
    joined = found.join(carried, [*keys, SLICE, SHARE], "left")
    version = F.coalesce("_inside", "_before")
    valid = version[valid_to].isNull() | (F.col("_at") <= version[valid_to])
    out = joined.withColumn("_found", F.when(valid & F.col("_at").isNotNull(), version))
    return out.select("_fact.*", "_found.*")
