"""Importance resampling of documents towards a target distribution of hashed n-grams.

Separators collapse to single blanks, and one overlapped regular expression scan emits
the spans of all runs of 1 to 3 words: every match is anchored at a word by the
blank before it, and nested groups end at the next three word borders, where a
lookahead holds the last one. A feature is such a run, its bucket the CRC-32 of its bytes
modulo BUCKETS.

Each document is scanned once and its buckets are written, two bytes a feature. Bucket
counts are summed per task and then by bucket over all rows, so the driver gets BUCKETS
numbers for the source and as many for the target, however large the tables are. The
gain of a bucket is the scaled log ratio of its shares in target and source; the weight
of a document is the sum over its features. Gumbel noise from a hash of the key turns
the largest scores into a sample without replacement. Ranks come from a range
partitioned sort and one offset per partition; no task sees more than its range.

A null text has no words, no features and weight 0. A null key is hashed as the empty
text and follows all others. Repeated rows are counted, weighted and drawn one by one;
rows that tie on score and key are ranked in the order they were read. An empty table
gives no rows; an empty target gives every bucket the share of its smoothing. Other
columns are ignored. A long text needs a few times its own size in its task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.frames import store, text_of

BUCKETS = 10_000
# Share of the documents with LEAST_WORDS words that is drawn, in percent.
PERCENT = 5
LEAST_WORDS = 20
SEED = 42

# A blank, then one, two and three words in nested groups, up to a blank.
RUNS = regex.compile(rb" ((([^ ]++)(?: [^ ]++)?+)(?: [^ ]++)?+)(?= )")


def _plain(code: int) -> int:
    """A byte with A-Z in lower case and separators as blanks; bytes of longer characters stay."""
    if 65 <= code <= 90:
        return code + 32
    return code if code >= 128 or 48 <= code <= 57 or 97 <= code <= 122 else 32


PLAIN = bytes(map(_plain, range(256)))


def collapsed(text: bytes) -> bytes:
    """The words of a text, each between single blanks."""
    return b" %b " % b" ".join(text.translate(PLAIN).split())


def buckets_of(blanked: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1 to 3 words."""

    def found() -> Iterator[int]:
        for match in RUNS.finditer(blanked, overlapped=True):
            three, two, one = match.groups()
            yield crc32(one) % buckets
            # At the last two words of a text the longer runs are missing.
            if len(two) > len(one):
                yield crc32(two) % buckets
                if len(three) > len(two):
                    yield crc32(three) % buckets

    return np.fromiter(found(), np.uint16)


SCANNED = "uid long, key {key}, n_words long, buckets binary"


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(uid, key, n_words, buckets) of every row, written: buckets as 16-bit integers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are kept as 16-bit integers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found = [], []
            for body in batch.column(2).cast(pa.binary()).to_pylist():
                blanked = collapsed(body)
                words.append(max(blanked.count(b" ") - 1, 0) if len(blanked) > 2 else 0)
                found.append(buckets_of(blanked, buckets).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "key", "n_words", "buckets"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"), text_of(docs, text).alias("body"))
    kind = docs.schema[key].dataType.simpleString()
    return store(rows.mapInArrow(run, SCANNED.format(key=kind)), "bucketed")


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of `scanned`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts += np.bincount(np.frombuffer(raw, np.uint16), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    parts = rows.select("buckets").mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) per bucket, both smoothed by one feature."""
    n = len(source)
    all_source, all_target = float(source.sum()) + n, float(target.sum()) + n
    ratios = (target + 1.0) * all_source / ((source + 1.0) * all_target)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(uid, key, n_words, n_features, weight) from rows of `scanned`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(raw, np.uint16) for raw in batch.column(3).to_pylist()]
            counts = pa.array([len(f) for f in found], pa.int64())
            weights = pa.array([int(gain[f].sum()) for f in found], pa.int64())
            columns = [batch.column(0), batch.column(1), batch.column(2), counts, weights]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "key", "n_words", "n_features", "weight"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"uid long, key {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u in (0, 1) from the hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`rows` with their place 1, 2, 3.. in a total order, without a window over all of them.

    Rows are sorted in range partitions, numbered there, and moved on by the size of
    the ranges before; only those sizes meet in one place, one row for each partition.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            n = batch.num_rows
            places = pa.array(np.arange(at + 1, at + n + 1, dtype=np.int64))
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, places], [*batch.schema.names, "_place"])

    columns = spread.withColumn("_range", F.spark_partition_id())
    shape = T.StructType([*columns.schema.fields, T.StructField("_place", T.LongType())])
    placed = store(columns.mapInArrow(run, shape), "ranked")
    sizes = sorted(placed.groupBy("_range").count().collect())
    starts, before = [], 0
    for number, size in sizes:
        starts.append((number, before))
        before += size
    offsets = rows.sparkSession.createDataFrame(starts, "_range int, _before long")
    out = placed.join(F.broadcast(offsets), "_range")
    return out.select(*rows.columns, (F.col("_before") + F.col("_place")).alias(name))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, n_features, weight, score, rank, n_words) of every row; rank is null where it is not drawn."""
    source = scanned(docs, key, text, buckets)
    wanted = target.select(F.lit(0).alias("_key"), text_of(target, text).alias("_text"))
    gain = gains(histogram(source, buckets), histogram(scanned(wanted, "_key", "_text", buckets), buckets))
    scored = weighed(source, gain).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    rows = store(scored, "scored")
    able = rows.where(F.col("n_words") >= least_words).select("uid", "key", "score")
    drawn = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("uid").asc()]
    places = ranked(able, order).where(F.col("rank") <= drawn).select("uid", "rank")
    out = rows.join(places, "uid", "left")
    return out.select(F.col("key").alias(key), "n_features", "weight", "score", "rank", "n_words")
