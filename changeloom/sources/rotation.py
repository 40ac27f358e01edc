"""Landing files closed by count and by time, found without walking all records one after the other.

A file is closed after a number of records, or by the first record that comes a span after the
file's first one, or where the key ends. Each cut depends on the one before, so the cuts
of a key form a chain. Records are numbered in one total order and dealt to blocks of consecutive
numbers. A block makes a jump table: for every record it may be entered at (a chain enters among the
first `records` ones), the last file start inside and how many there are. Tables of SUPER blocks
compose to one; those are walked in order, one small row after the other, and
tell every block where its chain enters. No block, table or key is held whole
by one task, and work is linear in the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeloom.operators.joins import lookup_join
from changeloom.session import shared_dir

# A bus sink closes a file after so many records, or so long after its first one.
RECORDS = 1000
SPAN_MS = 60_000
# Records of a block; blocks whose tables are composed in one task.
BLOCK = 1 << 16
SUPER = 1024

TABLE = "_block long, n int, first string, last string, head array<long>, same int, at array<int>, time array<long>, count array<int>"


def numbered(df: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """Add the place 0, 1, 2.. of every row in a total order.

    Rows are numbered inside their range partition, then moved on by the sizes of
    the ranges before, one row for each partition.
    """
    folder = shared_dir(df.sparkSession, "numbered")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(folder)
    ranged = df.sparkSession.read.parquet(folder)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    starts, before = [], 0
    for place, size in sorted(ranged.groupBy("_range").count().collect()):
        starts.append((place, before))
        before += size
    offsets = df.sparkSession.createDataFrame(starts, "_range int, _before long")
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(offsets), "_range")
    return placed.select(*df.columns, (F.col("_before") + F.col("_inside") - 1).alias(number))


def next_starts(keys: np.ndarray, times: np.ndarray, records: int, span: int) -> np.ndarray:
    """For each record as the first of a file, the first record of the next one; at most the number of records."""
    n = len(times)
    change = np.concatenate([[False], keys[1:] != keys[:-1]])
    segment = np.cumsum(change)
    # Keys one after the other on one clock, further apart than any span.
    apart = int(times.max() - times.min()) + span + 1
    clock = times - times.min() + segment * apart
    ends = np.append(np.flatnonzero(change), n)[segment]
    return np.minimum(np.minimum(np.arange(n) + records, np.searchsorted(clock, clock + span)), ends)


def jump_table(block: pd.DataFrame, records: int, span: int) -> pd.DataFrame:
    """The one-row table of a block."""
    block = block.sort_values("_number")
    keys, times = block["_key"].to_numpy(), block["_time"].to_numpy()
    n, m = len(block), min(records, len(block))
    following = next_starts(keys, times, records, span)
    last, count = np.arange(n), np.ones(n, np.int64)
    # Jumps are doubled until every one has left the block.
    to, steps = np.where(following < n, following, last), (following < n).astype(np.int64)
    while True:
        count_next = steps + steps[to]
        to_next = to[to]
        if (to_next == to).all():
            break
        to, steps = to_next, count_next
    same = int(np.argmax(keys != keys[0])) or n
    row = (block["_block"].iloc[0], n, keys[0], keys[-1], times[:m], min(same, m), to[:m], times[to[:m]], (count + steps)[:m])
    return pd.DataFrame([row], columns=[f.split()[0] for f in TABLE.split(", ")])


def entries(row: dict, size: int, last: str, at: np.ndarray, time: np.ndarray, records: int, span: int) -> np.ndarray:
    """Where the chain enters the block of `row` from last starts (at, time) in the block before, of `size` records."""
    if row["first"] != last:
        return np.zeros(len(at), np.int64)
    head = np.asarray(row["head"])[: row["same"]]
    late = np.searchsorted(head, time + span)
    # Past the head the key has changed there, or the count decides.
    return np.minimum(at + records - size, late)


def through(row: dict, entry: np.ndarray, at: np.ndarray, time: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Last start (place in its block, time) and number of starts after a block that is entered at `entry`."""
    inside = entry < row["n"]
    place = np.minimum(entry, row["n"] - 1)
    table = [np.asarray(row[c], np.int64) for c in ("at", "time", "count")]
    # A block without a start passes on the last one, seen from its own first record.
    return (
        np.where(inside, table[0][np.minimum(place, len(table[0]) - 1)], at - size),
        np.where(inside, table[1][np.minimum(place, len(table[1]) - 1)], time),
        np.where(inside, table[2][np.minimum(place, len(table[2]) - 1)], 0),
    )


def composed(blocks: pd.DataFrame, records: int, span: int) -> pd.DataFrame:
    """The tables of consecutive blocks as one: from each entry of the first to the end of the last."""
    rows = blocks.sort_values("_block").to_dict("records")
    first = rows[0]
    m = len(first["at"])
    at, time, count = (np.asarray(first[c], np.int64) for c in ("at", "time", "count"))
    for before, row in zip(rows, rows[1:]):  # noqa: B905
        entry = entries(row, before["n"], before["last"], at, time, records, span)
        at, time, more = through(row, entry, at, time, before["n"])
        count = count + more
    out = {**first, "n": rows[-1]["n"], "last": rows[-1]["last"], "at": at, "time": time, "count": count}
    return pd.DataFrame([{**out, "_size": int(first["n"]), "_m": m}])


def file_numbers(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: Sequence[str],
    out: str = "file",
    records: int = RECORDS,
    span_ms: int = SPAN_MS,
    block: int = BLOCK,
) -> DataFrame:
    """Add the number, from 0 in each key, of the landing file that every record goes to.

    Records follow each other by `time` (whole milliseconds) and `tie`, which must tell them
    apart and not be null. A block must hold at least `records` records.
    """
    if block < records:
        raise ValueError("a block must hold the records of a file")
    spark = df.sparkSession
    columns, keys = df.columns, list(keys)
    keyed = df.withColumn("_key", F.to_json(F.struct(*keys))).withColumn("_time", F.col(time).cast("long"))
    order = [F.col("_key"), F.col("_time"), *map(F.col, tie)]
    placed = numbered(keyed, order, "_number").withColumn("_block", F.floor(F.col("_number") / block).cast("long"))
    folder = shared_dir(spark, "rotation")
    placed.write.parquet(f"{folder}/records")
    placed = spark.read.schema(placed.schema).parquet(f"{folder}/records")

    slim = placed.select("_block", "_number", "_key", "_time")
    tables = slim.groupBy("_block").applyInPandas(lambda b: jump_table(b, records, span_ms), TABLE)
    tables.withColumn("_super", F.floor(F.col("_block") / SUPER).cast("long")).write.parquet(f"{folder}/tables")
    tables = spark.read.schema(f"{TABLE}, _super long").parquet(f"{folder}/tables")

    grouped = tables.groupBy("_super")
    supers = grouped.applyInPandas(
        lambda b: composed(b.drop(columns="_super"), records, span_ms).assign(_super=b["_super"].iloc[0]),
        f"{TABLE}, _size int, _m int, _super long",
    )
    entered = spark.createDataFrame(list(walk(supers.orderBy("_super").toLocalIterator(), records, span_ms)), ENTERED)

    def spread(frame: pd.DataFrame) -> pd.DataFrame:
        """Entry and number of files before, of each block of a super block."""
        found = []
        at = timed = size = last = None
        for row in frame.sort_values("_block").to_dict("records"):
            if last is None:
                entry, before = np.array([row["_entry"]]), int(row["_files"])
            else:
                entry = entries(row, size, last, at, timed, records, span_ms)
            found.append((row["_block"], int(entry[0]), before))
            start = (np.zeros(1, np.int64), np.zeros(1, np.int64)) if at is None else (at, timed)
            at, timed, more = through(row, entry, *start, size or 0)
            before += int(more[0])
            size, last = row["n"], row["last"]
        return pd.DataFrame(found, columns=["_block", "_entry", "_files"])

    inner = tables.join(F.broadcast(entered), "_super").groupBy("_super")
    chained = inner.applyInPandas(spread, "_block long, _entry int, _files long")
    chained.write.parquet(f"{folder}/entries")
    chained = spark.read.schema("_block long, _entry int, _files long").parquet(f"{folder}/entries")

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_number")
        following = next_starts(frame["_key"].to_numpy(), frame["_time"].to_numpy(), records, span_ms)
        starts, at = [], int(frame["_entry"].iloc[0])
        while at < len(frame):
            starts.append(at)
            at = int(following[at])
        number = np.searchsorted(starts, np.arange(len(frame)), side="right") - 1
        return pd.DataFrame({"_number": frame["_number"], "_file": frame["_files"].iloc[0] + number})

    slim.join(chained, "_block").groupBy("_block").applyInPandas(cut, "_number long, _file long").write.parquet(f"{folder}/files")
    files = spark.read.schema("_number long, _file long").parquet(f"{folder}/files")
    numbered_rows = placed.join(files, "_number")
    first = files.join(slim.select("_number", "_key"), "_number").groupBy("_key").agg(F.min("_file").alias("_first"))
    return lookup_join(numbered_rows, first, ["_key"]).select(*columns, (F.col("_file") - F.col("_first")).alias(out))


ENTERED = T.StructType([T.StructField("_super", T.LongType()), T.StructField("_entry", T.IntegerType()), T.StructField("_files", T.LongType())])


def walk(supers: Iterator, records: int, span: int) -> Iterator[tuple[int, int, int]]:
    """(super block, entry, files before it) in order, from one composed table at a time."""
    at = time = size = last = None
    files = 0
    for found in supers:
        row = found.asDict()
        entry = np.zeros(1, np.int64) if last is None else entries(row, size, last, at, time, records, span)
        yield int(row["_super"]), int(entry[0]), files
        start = (np.zeros(1, np.int64), np.zeros(1, np.int64)) if at is None else (at, time)
        inside = {**row, "n": row["_size"]}
        at, time, more = through(inside, entry, *start, size or 0)
        files += int(more[0])
        size, last = row["n"], row["last"]
