"""Helpers shared by the operators: text columns as arrays, written intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.session import shared_dir

# Characters of text that are held as arrays at once inside a task.
BLOCK_CHARS = 1 << 17

# Elements of an array that are scanned in one go.
SCAN_CHUNK = 512

# Rows of an Arrow batch: texts are long, and a task holds a batch several times over.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "500"


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once per context, and keep Arrow batches of texts small."""
    context = spark.sparkContext
    if not context.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    if getattr(context, "_changeloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="changeloom-ship-")
    archive = shutil.make_archive(f"{folder}/changeloom", "zip", root.parent, root.name)
    context.addPyFile(archive)
    context._changeloom_shipped = True


def text_of(df: DataFrame, name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` evaluated once however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Inclusive scan of an array of numbers >= 0 with an associative `op` whose identity is 0.

    Arrays grow by copying, so they are kept short: chunks are scanned one by one, then
    raised by what came before them. `values` must be a column or a lambda variable.
    """
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SCAN_CHUNK).cast("int")),
        lambda k: F.slice(values, k * SCAN_CHUNK + 1, SCAN_CHUNK),
    )
    grow = lambda acc, x: F.concat(acc, F.array(op(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)), x)))
    none = F.array().cast("array<int>")
    last = lambda part: F.get(part, F.size(part) - 1)

    def raised(parts: Column) -> Column:
        heights = F.aggregate(F.transform(parts, last), none, grow)
        return bound(heights, lambda h: F.flatten(F.transform(parts, lambda p, k: F.when(k == 0, p).otherwise(lifted(p, F.get(h, k - 1))))))

    def lifted(part: Column, height: Column) -> Column:
        return F.transform(part, lambda x: op(height, x))

    return F.when(F.size(values) > 0, bound(F.transform(chunks, lambda c: F.aggregate(c, none, grow)), raised)).otherwise(none)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text or binary column and the bounds of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(sizes: Sequence[int], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to `limit` at most, or single larger rows."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """64-bit hashes of any ranges of a sequence from one prefix sum."""

    # Odd bases and their inverses modulo 2^64.
    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
    _tables: dict = {}

    def __init__(self, values: np.ndarray, which: int = 0):
        base = self.BASES[which]
        n = len(values) + 1
        if which not in self._tables or len(self._tables[which][0]) < n:
            size = max(2 * n, 1 << 16)
            inverse = pow(base, -1, 1 << 64)
            self._tables[which] = (powers(base, size), powers(inverse, size))
        up, self.down = self._tables[which]
        self.sums = np.zeros(n, dtype=np.uint64)
        spread = lambda v: mixed(v.astype(np.uint64) + np.uint64(which + 1))
        drawn = spread(np.arange(256))[values] if values.dtype == np.uint8 else spread(values)
        np.cumsum(drawn * up[: n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end]."""
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(h + (ends - starts).astype(np.uint64))
