"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else is a blank; n-grams of ORDERS letters
that start or end in a letter are hashed into BUCKETS. The log-probability matrix
(BUCKETS x languages, at most MAX_LANGUAGES) is broadcast and a block of texts is
scored at once as the product of its sparse count matrix with it.

The classifier is fitted on a bounded sample: about SAMPLE_PER_LANGUAGE labelled
documents of each language, drawn by the hash of key and text. Nulls and texts
without a letter are `und` with score 0; so is every text if nothing is labelled.
Ties go to the first language in alphabetical order. Repeated rows are scored one
by one, texts of any length whole; empty tables give no rows; other columns are
ignored by `identify` and kept by `keep`.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import blocks, mixed, text_of
from changeloom.llm.pretokens import code_points

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 3000
MAX_LANGUAGES = 256
UNKNOWN = "und"
# Documents below this posterior are rejected by `keep`.
LEAST_SCORE = 0.5
BLOCK = 1 << 17


@cache
def lowered() -> np.ndarray:
    """Lower-case letter of every code point, blank for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and letters per text."""
    codes, bounds = code_points(texts)
    low = lowered()[codes]
    letter = low != 32
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    letters = np.bincount(owner[letter], minlength=len(texts))
    found, whose = [], []
    for n in ORDERS:
        m = len(low) - n + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint64)
        for k in range(n):
            value = (value << np.uint64(21)) | low[k : k + m].astype(np.uint64)
        valid = (owner[:m] == owner[n - 1 :]) & (letter[:m] | letter[n - 1 :])
        found.append((mixed(value[valid] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32))
        whose.append(owner[:m][valid])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), letters
    return np.concatenate(found), np.concatenate(whose), letters


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of every text."""
        bucket, owner, letters = grams(texts)
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        # One row per text and bucket: the sparse count matrix.
        cell, count = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
        row, column = cell // BUCKETS, cell % BUCKETS
        total = np.zeros((n, len(self.languages)))
        if len(cell):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            total[row[first]] = np.add.reduceat(self.weights[column] * count[:, None], first, axis=0)
        best = total.argmax(1)
        chance = 1 / np.exp(total - total[np.arange(n), best][:, None]).sum(1)
        some = letters > 0
        names = [self.languages[i] if s else UNKNOWN for i, s in zip(best, some, strict=True)]
        return names, np.where(some, chance, 0.0)


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on a sample of `labelled`; rows without a language are left out."""
    rows = labelled.where(F.col(lang).isNotNull())
    counts = {r["name"]: r["n"] for r in rows.groupBy(F.col(lang).cast("string").alias("name")).agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return Model((), np.zeros((BUCKETS, 0)))
    slots = 1_000_000
    shares = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(slots, -(-SAMPLE_PER_LANGUAGE * slots // n)))])
    # By key and text: rows without a key, or with one key, are not drawn all or none.
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string"), text_of(rows, text), F.lit("language")), F.lit(slots)) < shares[F.col(lang).cast("string")]
    sample = rows.where(drawn).select(F.col(lang).cast("string").alias("name"), text_of(rows, text).alias("body"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in blocks([len(t) for t in texts], BLOCK):
                bucket, owner, _ = grams(texts[a:b])
                here = np.array(names[a:b])
                for name in set(names[a:b]):
                    mine = np.bincount(bucket[(here == name)[owner]], minlength=BUCKETS)
                    total[name] = total.get(name, 0) + mine
        for name, row in total.items():
            some = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(row[some], pa.int64())], ["name", "bucket", "n"]
            )

    sums = sample.mapInArrow(count, "name string, bucket int, n long").groupBy("name", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    languages = tuple(sorted(counts))
    matrix = np.zeros((BUCKETS, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    matrix[table["bucket"], table["name"].map(place)] = table["n"]
    smooth = matrix + 0.5
    return Model(languages, np.log(smooth) - np.log(smooth.sum(0)))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks([len(t) for t in texts], BLOCK):
                names, scores = shared.value.score(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "lang_pred", "score"])

    source = docs.select(F.col(key).alias("key"), text_of(docs, text).alias("body"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def held_out(key: Column) -> Column:
    """Documents that the classifier never learns from."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def keep(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """`docs` without texts whose language is unknown or less likely than `least`."""
    packed = docs.select(F.struct("*").alias("row"), text_of(docs, text).alias("text"))
    known = identify(packed, model, "row", "text").where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return known.select("row.*")
