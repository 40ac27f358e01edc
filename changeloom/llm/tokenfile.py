"""Token files: ids of documents, each compressed by itself with a shared dictionary.

A file is a table of blocks. A block is one binary value with a header:

    magic "CLTK", version (u16), bytes per id (u16), documents n (u32),
    SHA-256 of the dictionary (32 bytes), keys (n x i64), ids per document (n x u32),
    offsets of the frames (n+1 x u64), then the zstandard frames

so one short document is read by its offset without touching its neighbours.
The dictionary, trained on serialised id arrays, lies beside the blocks. Blocks
follow ascending key within a shard and shards follow each other, in range
partitions of (key, text hash): one key with many rows is spread over several.

Null texts are empty texts and hold the end id alone. Null keys come first and
are marked in the block table. Repeated rows are kept one by one; ties of a key
follow the hash of their text. An empty table gives an empty file and no rows.
Columns other than key and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.llm.frames import blocks, text_of
from changeloom.llm.pretokens import PieceEncoder, byte_letters

MAGIC, VERSION = b"CLTK", 1
HEAD = struct.Struct("<4sHHI32s")
# Bytes of the dictionary, and the bounded sample it is trained on.
DICTIONARY_BYTES = 1 << 16
SAMPLE_DOCUMENTS = 800
SAMPLE_IDS = 2048
# Ids gathered into one block; a longer document has a block of its own.
BLOCK_IDS = 1 << 18
LEVEL = 3


@dataclass(frozen=True)
class LibraryTokenizer:
    """Encodes with a vocabulary file of the tokenizers library."""

    path: str

    def load(self) -> Callable[[Sequence[str]], list[np.ndarray]]:
        kept = _loaded.get(self.path)
        if kept is None:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(self.path)
            special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

            # Pieces are cut already: they go straight to the merges, spelled as the vocabulary spells bytes.
            model, spelled = tokenizer.model, {byte: letter for letter, byte in byte_letters().items()}

            def pieces(batch: list[str]) -> list[list[int]]:
                words = [p.encode().decode("latin-1").translate(spelled) for p in batch]
                return [[token.id for token in model.tokenize(word)] for word in words]

            encoder = PieceEncoder(pieces)
            kept = _loaded[self.path] = lambda texts: encoder.texts(texts, special)
        return kept


_loaded: dict = {}


def id_type(width: int) -> str:
    return "<u2" if width == 2 else "<u4"


def train_dictionary(arrays: Sequence[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; empty where the sample is too small for one."""
    total = sum(map(len, arrays))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), list(arrays), level=LEVEL, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b""


def pack(dictionary: bytes, width: int, keys: Sequence[int], arrays: Sequence[np.ndarray]) -> bytes:
    """One block."""
    compressor = _compressor(dictionary)
    frames = [compressor.compress(a.astype(id_type(width)).tobytes()) for a in arrays]
    offsets = np.cumsum([0, *map(len, frames)], dtype="<u8")
    head = HEAD.pack(MAGIC, VERSION, width, len(frames), hashlib.sha256(dictionary).digest())
    counts = np.array([len(a) for a in arrays], "<u4")
    return b"".join([head, np.array(keys, "<i8").tobytes(), counts.tobytes(), offsets.tobytes(), *frames])


class Block:
    """A block opened for reading; checks that the dictionary is the one it was written with."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, version, self.width, n, digest = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token block")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        at = HEAD.size
        self.keys = np.frombuffer(data, "<i8", n, at)
        self.counts = np.frombuffer(data, "<u4", n, at + 8 * n)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 12 * n).astype(np.int64)
        self.data, self.start = data, at + 12 * n + 8 * (n + 1)
        self.decompressor = _decompressor(dictionary)

    def raw(self, i: int) -> bytes:
        """Serialised ids of document i."""
        frame = self.data[self.start + self.offsets[i] : self.start + self.offsets[i + 1]]
        return self.decompressor.decompress(frame, max_output_size=int(self.counts[i]) * self.width)

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), id_type(self.width))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=LEVEL, **shared)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdDecompressor(**shared)


def sample_arrays(docs: DataFrame, tokenizer: LibraryTokenizer, width: int, key: str, text: str) -> list[bytes]:
    """Serialised ids of about SAMPLE_DOCUMENTS documents, SAMPLE_IDS of each at most, from a hashed place on.

    The dictionary alone is fitted on them; it changes sizes, never contents.
    """
    every = max(1, docs.count() // SAMPLE_DOCUMENTS)
    # Equal rows count once, so what reaches the driver does not grow with the copies.
    body = text_of(docs, text)
    start = 1 + F.pmod(F.hash(body), F.greatest(F.length(body) - 8 * SAMPLE_IDS + 1, F.lit(1)))
    piece = F.substring(body, start, F.lit(8 * SAMPLE_IDS)).alias("piece")
    drawn = docs.select(F.xxhash64(F.col(key), body).alias("drawn"), piece).where(F.pmod("drawn", F.lit(every)) == 0)
    some = drawn.groupBy("drawn").agg(F.first("piece").alias("piece")).orderBy("drawn").limit(2 * SAMPLE_DOCUMENTS)
    texts = [r[0] for r in some.select("piece").collect()]
    return [ids[:SAMPLE_IDS].astype(id_type(width)).tobytes() for ids in tokenizer.load()(texts)]


def write(
    docs: DataFrame,
    path: str,
    tokenizer: LibraryTokenizer,
    end_id: int,
    width: int = 4,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the ids of all texts, each followed by `end_id`, in ascending order of `key`."""
    spark = docs.sparkSession
    dictionary = train_dictionary(sample_arrays(docs, tokenizer, width, key, text))
    shelf = spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary")
    shelf.coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, number = tokenizer.load(), TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        arrays: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            data = pack(dictionary, width, [k or 0 for k in keys], arrays)
            total = sum(map(len, arrays))
            nulls = sum(k is None for k in keys)
            columns = [[shard], [number], [len(keys)], [nulls], [total], [data]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            number += 1
            keys.clear()
            arrays.clear()
            cells = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(cells, ["shard", "block", "n_docs", "n_null_keys", "n_ids", "data"])

        held = 0
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks([len(t) for t in texts]):
                for name, ids in zip(names[a:b], encode(texts[a:b]), strict=True):
                    if arrays and held + len(ids) > BLOCK_IDS:
                        yield flush()
                        held = 0
                    keys.append(name)
                    arrays.append(np.append(ids, end_id).astype(np.uint32))
                    held += len(ids) + 1
        if arrays:
            yield flush()

    source = docs.select(F.col(key).cast("long").alias("key"), text_of(docs, text).alias("body"))
    # The row number tells equal rows apart, so that they can be spread as well.
    order = [F.col("key").asc_nulls_first(), F.xxhash64("body"), F.col("number")]
    numbered = source.withColumn("number", F.monotonically_increasing_id())
    rows = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("number")
    packed = rows.mapInArrow(run, "shard int, block long, n_docs long, n_null_keys long, n_ids long, data binary")
    packed.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def dictionary_of(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.schema("dictionary binary").parquet(f"{path}/dictionary").first()[0])


BLOCK_SCHEMA = "shard int, block long, n_docs long, n_null_keys long, n_ids long, data binary"


def read_index(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the frames of the file.

    `start` counts the ids of all documents before it. Shards are summed first,
    blocks within their shard next, documents within their block last, so no
    task holds more than the blocks of one shard.
    """
    dictionary = dictionary_of(spark, path)
    table = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, nulls, data in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                block = Block(data, dictionary)
                n = len(block.keys)
                raws = [block.raw(i) for i in range(n)]
                counts = np.array([len(r) // block.width for r in raws], np.int64)
                sums = [zlib.crc32(r if block.width == 4 else block.ids(i).astype("<u4").tobytes()) for i, r in enumerate(raws)]
                keys = pa.array(block.keys, pa.int64(), mask=np.arange(n) < nulls)
                columns = [
                    pa.array(np.full(n, shard), pa.int32()),
                    pa.array(np.full(n, number), pa.int64()),
                    keys,
                    pa.array(np.cumsum(counts) - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "key", "within", "n_tokens", "ids_crc32"])

    shape = "shard int, block long, key long, within long, n_tokens long, ids_crc32 long"
    documents = table.select("shard", "block", "n_null_keys", "data").mapInArrow(run, shape)
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.coalesce(F.sum("n_ids").over(earlier_in(earlier, ["shard"], [])), F.lit(0))
    shards = shards.select("shard", before.alias("shard_start"))
    inside = F.coalesce(F.sum("n_ids").over(earlier_in(earlier, ["block"], ["shard"])), F.lit(0))
    starts = sizes.select("shard", "block", inside.alias("block_start")).join(shards, "shard")
    out = documents.join(starts, ["shard", "block"])
    start = F.col("shard_start") + F.col("block_start") + F.col("within")
    return out.select(F.col("key").alias(key), start.alias("start"), "n_tokens", "ids_crc32")


def earlier_in(frame, order: list[str], within: list[str]):
    return frame.partitionBy(*within).orderBy(*order) if within else frame.orderBy(*order)


def read_document(spark: SparkSession, path: str, key: int) -> list[list[int]]:
    """Ids of the documents with one key, by offset, from the blocks that may hold it."""
    dictionary = dictionary_of(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nulls, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block = Block(data, dictionary)
                found = np.flatnonzero(block.keys == key)
                rows = [block.ids(i).tolist() for i in found if i >= nulls]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], ["ids"])

    table = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return [r.ids for r in table.select("n_null_keys", "data").mapInArrow(run, "ids array<long>").collect()]
