"""Previous and next row per key, without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    cols: Sequence[str] = (),
    chunk: int | None = None,
) -> DataFrame:
    """Add `_prev` and `_next`: structs of (seq, *cols) of the rows around.

    Expects one row per (keys, seq), an integer `seq` and non-null keys. With
    `chunk`, the windows run per `chunk`-wide slice of the sequence (so at most
    `chunk` rows each), and the rows at the slice edges are linked through one
    summary row per slice.
    """
    keys = list(keys)
    row = F.struct(seq, *cols)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(seq)
        return df.withColumns({"_prev": F.lag(row).over(w), "_next": F.lead(row).over(w)})

    sliced = df.withColumn("_chunk", F.floor(F.col(seq) / chunk).cast("long"))
    w = Window.partitionBy(*keys, "_chunk").orderBy(seq)
    inner = sliced.withColumns({"_prev": F.lag(row).over(w), "_next": F.lead(row).over(w)})
    edges = sliced.groupBy(*keys, "_chunk").agg(
        F.min(row).alias("_first"), F.max(row).alias("_last")
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    linked = edges.select(
        *keys,
        "_chunk",
        F.lag("_last").over(along).alias("_before"),
        F.lead("_first").over(along).alias("_after"),
    )
    return (
        inner.join(linked, [*keys, "_chunk"])
        .withColumn("_prev", F.coalesce("_prev", "_before"))
        .withColumn("_next", F.coalesce("_next", "_after"))
        .drop("_chunk", "_before", "_after")
    )
