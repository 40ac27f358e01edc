"""Change-log operators: unwrap, collapse to current state, apply, diff."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Metadata columns of a flat change row.
OP = "__op"
TS_MS = "__ts_ms"
LSN = "__source_lsn"
SNAPSHOT = "__source_snapshot"
SOURCE_TABLE = "__source_table"
SOURCE_SCHEMA = "__source_schema"
DELETED = "__deleted"

ORDER = (LSN, TS_MS)


def envelope_type(row: T.StructType) -> T.StructType:
    """The nested change envelope around rows of type `row`."""
    source = T.StructType(
        [
            T.StructField("lsn", T.LongType()),
            T.StructField("snapshot", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("schema", T.StringType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("source", source),
        ]
    )


def unwrap_envelope(df: DataFrame, payload: str | None = None) -> DataFrame:
    """Flatten `{before, after, op, ts_ms, source}` into one row per change.

    Deletes keep their row (the before image) and are marked; an empty payload,
    as written after a delete for log compaction, is dropped.
    `payload` names a struct column holding the envelope; by default its fields
    are top-level columns.
    """
    p = f"{payload}." if payload else ""
    image = F.coalesce(F.col(f"{p}after"), F.col(f"{p}before"))
    return (
        df.select(
            image.alias("_image"),
            F.col(f"{p}op").alias(OP),
            F.col(f"{p}ts_ms").alias(TS_MS),
            F.col(f"{p}source.lsn").alias(LSN),
            F.col(f"{p}source.snapshot").alias(SNAPSHOT),
            F.col(f"{p}source.table").alias(SOURCE_TABLE),
            F.col(f"{p}source.schema").alias(SOURCE_SCHEMA),
        )
        .where(F.col("_image").isNotNull())
        .select(
            "_image.*",
            OP,
            TS_MS,
            LSN,
            SNAPSHOT,
            SOURCE_TABLE,
            SOURCE_SCHEMA,
            F.when(F.col(OP) == "d", "true").otherwise("false").alias(DELETED),
        )
    )


def unwrap_json(df: DataFrame, column: str, row: T.StructType) -> DataFrame:
    """Parse a JSON envelope column, then flatten it."""
    parsed = df.select(F.from_json(F.col(column), envelope_type(row)).alias("_env"))
    return unwrap_envelope(parsed, "_env")


def is_tombstone(op: str = OP, deleted: str | None = None) -> Column:
    """True for a delete; a missing operation counts as a snapshot read."""
    flag = F.coalesce(F.col(op), F.lit("r")) == "d"
    if deleted is not None:
        flag = flag | (F.coalesce(F.col(deleted), F.lit("false")) == "true")
    return flag


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The newest row per key: highest `order`, nulls last, then `tiebreak`.

    Spark cuts each input split to one row per key before the shuffle
    (WindowGroupLimit), so a hot key costs one row per split. A composite key is
    led by its hash: the sort then settles nearly all comparisons on that one
    fixed-width prefix instead of walking through the key columns.
    """
    newest = [F.col(c).desc_nulls_last() for c in (*order, *tiebreak)]
    if len(keys) == 1:
        ranking = Window.partitionBy(*keys).orderBy(*newest)
    else:
        df = df.withColumn("_hash", F.xxhash64(*keys))
        ranking = Window.partitionBy("_hash", *keys).orderBy(*newest)
    ranked = df.withColumn("_rn", F.row_number().over(ranking))
    return ranked.where("_rn = 1").drop("_rn", "_hash")


def apply_changes(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Keyed merge: state plus batch, newest row per key, tombstones kept.

    The result depends only on the set of change rows seen, so batches may
    arrive late, twice or in any order. Columns one side lacks become null.
    """
    merged = state.unionByName(batch, allowMissingColumns=True)
    return latest_by_key(merged, keys, order, tiebreak)


def live_rows(state: DataFrame, flag: str = "_is_deleted") -> DataFrame:
    """The state without its tombstones."""
    return state.where(~F.col(flag)).drop(flag)


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows (c, u, d) that turn one keyed snapshot into the next.

    A delete carries its key and its last payload. Both inputs hold one row per
    key, so the full join has no hot key.
    """
    payload = [c for c in current.columns if c not in keys]
    p = previous.select(*keys, F.struct(*payload).alias("_before"))
    c = current.select(*keys, F.struct(*payload).alias("_after"))
    op = (
        F.when(F.col("_before").isNull(), "c")
        .when(F.col("_after").isNull(), "d")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "u")
    )
    image = F.coalesce("_after", "_before")
    return (
        p.join(c, list(keys), "full")
        .withColumn(OP, op)
        .where(F.col(OP).isNotNull())
        .select(*keys, *[image[name].alias(name) for name in payload], OP)
    )


def high_water_mark(target: DataFrame, column: str) -> Column:
    """Newest stamp in `target` as a scalar subquery, the epoch when empty."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return target.agg(F.coalesce(F.max(column).cast("timestamp"), epoch)).scalar()


def newer_than(source: DataFrame, stamp: str, target: DataFrame, mark: str) -> DataFrame:
    """Rows of `source` stamped after everything already in `target`."""
    return source.where(F.col(stamp).cast("timestamp") > high_water_mark(target, mark))


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Append frames whose later versions gained columns; gaps become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
