"""Rows on their way to a partitioned write, as compressed blocks of columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bytes of rows that a task sorts into blocks at a time.
CHUNK_BYTES = 64 * 1024 * 1024
BLOCK = "_block"
# Types that come back from a block exactly as they went in.
PLAIN = (
    T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def fits_blocks(schema: T.StructType) -> bool:
    return all(type(f.dataType) in PLAIN for f in schema.fields)


def packed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Blocks of rows that agree in the columns `by`, as these columns and a small Parquet file each.

    A block holds the rows of one partition within about `CHUNK_BYTES` of a task. Shuffled rows are wide and
    compressed row by row; a block takes a third of their bytes.
    """
    by = list(by)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                yield blocks_of(held, by)
                held, size = [], 0
        if sum(batch.num_rows for batch in held):
            yield blocks_of(held, by)

    return df.mapInArrow(pack, T.StructType([*[df.schema[c] for c in by], T.StructField(BLOCK, T.BinaryType())]))


def blocks_of(batches: Sequence[pa.RecordBatch], by: Sequence[str]) -> pa.RecordBatch:
    """One row per combination of `by` in the batches; rows keep their order within it."""
    table = pa.Table.from_batches(batches)
    number = np.zeros(table.num_rows, dtype=np.int64)
    for column in by:
        values = table.column(column).combine_chunks().dictionary_encode()
        index = values.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        _, number = np.unique(number * (len(values.dictionary) + 1) + index, return_inverse=True)
    order = np.argsort(number, kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    starts = np.flatnonzero(np.diff(number[order], prepend=-1))
    ends = [*starts[1:].tolist(), table.num_rows]
    blocks = [block_of(table.slice(a, b - a)) for a, b in zip(starts.tolist(), ends, strict=True)]
    keys = table.select(list(by)).take(pa.array(starts)).combine_chunks()
    return keys.append_column(BLOCK, pa.array(blocks, pa.binary())).to_batches()[0]


def block_of(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    pq.write_table(rows, sink, compression="zstd", write_statistics=False, store_schema=False)
    return sink.getvalue().to_pybytes()


def unpacked(blocks: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of the blocks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(BLOCK):
                yield from pq.read_table(pa.BufferReader(block.as_buffer())).to_batches()

    return blocks.select(BLOCK).mapInArrow(unpack, schema)
