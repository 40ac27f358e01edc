"""Similarity join on word shingles: Bayesian candidate pruning, then exact Jaccard.

A text is the set of its runs of SHINGLE words (a shorter text with words is one
run). Texts with equal sets are one class. Classes meet in the buckets of BANDS
bands of their MinHash signatures; inside a bucket the MinHash values of a pair are
compared CHUNK at a time, and the pair is dropped as soon as the posterior
probability that its similarity reaches THRESHOLD, given the matches so far and a
uniform prior, falls below TOLERANCE. Pairs that stay join classes into families.
Inside a family every pair is verified exactly, on the whole shingle sets.

A pair of similarity 0.8 misses all 32 bands with probability 5e-8.

Buckets and families beyond BUCKET and FAMILY members are dealt out as pairs of
blocks, so no task ever holds more than two blocks, and no pair is written as a
row: tasks return link counts and spanning edges. Their work still is the number
of pairs of different texts in the family, which exact link counts need.

A null or wordless text has the empty set; all of those are one class, without
links to others. Repeated rows are copies. Empty tables give no rows; other columns
are ignored by `join_texts` and kept by `keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.components import components
from changeloom.llm.frames import RangeHash, blocks, mixed, store, text_of, utf8

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
CHUNK = 32
BUCKET = 256
FAMILY = 128
BLOCK = 1 << 18
# Columns of a 0/1 block matrix at once.
WIDTH = 1 << 14

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_draw = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
FACTORS = ((_draw[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
SHIFTS = (_draw[HASHES:] >> np.uint64(32)).astype(np.uint32)[:, None]


def shingle_sets(raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ordered different shingle hashes of every text."""
    n, docs = len(raw), len(bounds) - 1
    inside = ~WHITE[raw]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = RangeHash(RangeHash(raw, 0).of(starts, ends), 1)
    cuts = np.searchsorted(starts, bounds)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            out.append(np.zeros(0, np.uint64))
            continue
        begin = np.arange(a, max(a + 1, b - SHINGLE + 1))
        out.append(np.unique(words.of(begin, np.minimum(begin + SHINGLE, b))))
    assert len(out) == docs
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of 16 bits."""
    if not len(shingles):
        return np.zeros(HASHES, np.uint16)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full((HASHES, 1), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), WIDTH):
        values = FACTORS * x[at : at + WIDTH][None, :] + SHIFTS
        least = np.minimum(least, values.min(axis=1, keepdims=True))
    # The low bits of a minimum are not biased towards zero once they are mixed.
    return (mixed(least[:, 0].astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def least_matches(tolerance: float = TOLERANCE) -> list[int]:
    """For CHUNK, 2 CHUNK ... HASHES compared values, the fewest matches that keep a pair.

    With a uniform prior the similarity given m matches of n is Beta(m+1, n-m+1),
    and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in range(CHUNK, HASHES + 1, CHUNK):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * THRESHOLD**m * (1 - THRESHOLD) ** (n + 1 - m)
        out.append(m)
    return out


LEAST = least_matches()


def surviving_pairs(left: np.ndarray, right: np.ndarray, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of signature rows that the posterior keeps; `upper` compares a block with itself."""
    if upper:
        i, j = np.triu_indices(len(left), 1)
    else:
        i, j = (x.ravel() for x in np.indices((len(left), len(right))))
    matches = np.zeros(len(i), np.int32)
    for step, least in enumerate(LEAST):
        part = slice(step * CHUNK, (step + 1) * CHUNK)
        matches += (left[i, part] == right[j, part]).sum(1, dtype=np.int32)
        stay = matches >= least
        i, j, matches = i[stay], j[stay], matches[stay]
        if not len(i):
            break
    return i, j


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n members with edges (i, j), the least member connected to each."""
    root = np.arange(n)
    while len(i):
        # Roots are hung on roots, so members that agree once go on agreeing.
        p, q = root[i], root[j]
        low = np.minimum(p, q)
        np.minimum.at(root, p, low)
        np.minimum.at(root, q, low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


SIGNED = "t long, check long, c1 long, c2 long, n int, sig binary"


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, t, check, c1, c2, n, sig): identity of the text, of its set, size, signature."""
    body = text_of(docs, text)
    source = docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("t"), F.xxhash64(F.lit("second"), body).alias("check"), body.alias("body"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = utf8(batch.column(3))
            for a, b in blocks(np.diff(bounds).tolist(), BLOCK):
                sets = shingle_sets(raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                name = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                names = np.frombuffer(b"".join(name), np.int64).reshape(-1, 2)
                rows = batch.slice(a, b - a)
                columns = [
                    *(rows.column(c) for c in range(3)),
                    pa.array(names[:, 0].copy()),
                    pa.array(names[:, 1].copy()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "t", "check", "c1", "c2", "n", "sig"])

    return source.mapInArrow(run, f"key {kind}, {SIGNED}")


def dealt(rows: DataFrame, group: list[str], size: Column, block: int) -> DataFrame:
    """Members of a group of `size` dealt to pairs of blocks (i <= j); `side` tells which block."""
    parts = F.ceil(size / block).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit("block")), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    spread = rows.withColumn("mine", mine).select("*", parts.alias("parts"), other)
    return spread.select(
        *[c for c in rows.columns],
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"),
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: int, most: int = 4096) -> Iterator[pa.Table]:
    """Whole groups of rows with equal first `keys` columns, from sorted rows, several at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < most:
            continue
        table = pa.Table.from_batches(held)
        cut = 0
        if len(table) > 1:
            starts = group_starts(table, keys)
            cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        count = len(table) - cut
    if count:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: int) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[0] = True
    for k in range(keys):
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Spanning edges (a, b) of the class pairs that survive pruning in any bucket."""
    # The 16-bit values of a band are its bucket: four of them in one word.
    word = lambda i: F.conv(F.hex(F.substring("sig", 8 * i + 1, 8)), 16, -10).cast("long")
    bands = F.array(*[F.struct(F.lit(i).alias("band"), word(i).alias("value")) for i in range(BANDS)])
    rows = classes.where("n > 0").select("node", F.inline(bands))
    # Written first: a join of two plain shuffles can be split where a bucket is crowded.
    counts = store(rows.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = rows.join(counts, ["band", "value"])
    members = members.join(classes.select("node", "sig"), "node")
    slim = members.select("band", "value", "size", "node", "sig")
    placed = dealt(slim, ["band", "value"], F.col("size"), BUCKET).select("band", "value", "i", "j", "side", "node", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 4):
            starts = group_starts(table, 4)
            i, j, side, node = (table.column(c).to_numpy() for c in (2, 3, 4, 5))
            sigs = np.frombuffer(utf8(table.column(6).combine_chunks())[0].tobytes(), np.uint16).reshape(-1, HASHES)
            a_out, b_out = [], []
            for a, b in zip(starts, np.append(starts[1:], len(table)), strict=True):
                if i[a] == j[a]:
                    # A block with itself: each member comes once.
                    p, q = surviving_pairs(sigs[a:b], sigs[a:b], True)
                    names = node[a:b]
                else:
                    one, two = np.flatnonzero(side[a:b] == 0), np.flatnonzero(side[a:b] == 1)
                    p, q = surviving_pairs(sigs[a:b][one], sigs[a:b][two], False)
                    p, q, names = one[p], two[q], node[a:b]
                root = spanning(b - a, p, q)
                linked = np.flatnonzero(root != np.arange(b - a))
                a_out.append(names[linked])
                b_out.append(names[root[linked]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])

    keys = ["band", "value", "i", "j"]
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def verified(classes: DataFrame, families: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(node, other, links): exact links of the classes, counted in documents, with spanning edges.

    `links` are the documents of other classes that `node` is linked to in one
    pair of blocks; `other` is the least class connected to it there, or null.
    """
    sizes = store(families.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    wanted = families.join(sizes, "root").join(classes.select("node", "copies", "t", "check"), "node")
    body = text_of(docs, text)
    texts = docs.select(F.xxhash64(body).alias("t"), F.xxhash64(F.lit("second"), body).alias("check"), body.alias("body"))
    texts = texts.groupBy("t", "check").agg(F.first("body").alias("body"))
    rows = texts.join(wanted, ["t", "check"]).select("root", "size", "node", "copies", "body")
    order = ["root", "i", "j", "side", "node", "copies", "body"]
    placed = dealt(rows, ["root"], F.col("size"), FAMILY).select(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 3, 2 * FAMILY):
            starts = group_starts(table, 3)
            i, j, side, node, copies = (table.column(c).to_numpy() for c in range(1, 6))
            for a, b in zip(starts, np.append(starts[1:], len(table)), strict=True):
                raw, bounds = utf8(table.column(6).slice(a, b - a).combine_chunks())
                sets = shingle_sets(raw, bounds)
                near = similar(sets)
                if i[a] != j[a]:
                    near &= side[a:b][:, None] != side[a:b][None, :]
                links = near @ copies[a:b].astype(np.int64)
                p, q = np.nonzero(np.triu(near, 1))
                root = spanning(b - a, p, q)
                own = root == np.arange(b - a)
                some = links > 0
                columns = [
                    pa.array(node[a:b][some]),
                    pa.array(node[a:b][root][some], pa.int64(), mask=own[some]),
                    pa.array(links[some]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "other", "links"])

    keys = ["root", "i", "j"]
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node long, other long, links long")


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Whether the exact Jaccard similarity of each pair of sets reaches THRESHOLD."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), sizes)
    _, column = np.unique(flat, return_inverse=True)
    common = np.zeros((n, n))
    turn = np.argsort(column, kind="stable")
    row, column = row[turn], column[turn]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, WIDTH):
        a, b = np.searchsorted(column, (at, at + WIDTH))
        matrix = np.zeros((n, WIDTH), np.float32)
        matrix[row[a:b], column[a:b] - at] = 1
        common += matrix @ matrix.T
    union = sizes[:, None] + sizes[None, :] - common
    near = (common >= THRESHOLD * union - 1e-9) & (common > 0)
    np.fill_diagonal(near, False)
    return near


def join_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, t, check, root, class_id, n_links, n_copies) of every row.

    `root` identifies the connected component of the row within this result. `class_id`
    is the least key of the component: null if all its keys are null, and no identity
    where unrelated texts share a key. `n_links` is
    the number of other rows with similarity THRESHOLD or more, `n_copies` the
    rows with an equal shingle set, itself included.
    """
    rows = store(signed(docs, key, text), "signed")
    least = F.min(F.struct("t", "check")).alias("one")
    classes = rows.groupBy("c1", "c2").agg(
        F.count("*").alias("copies"), F.min("key").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"), least
    )
    node = F.monotonically_increasing_id().alias("node")
    # Numbered and written once: from here on a class keeps its number.
    classes = store(classes.select(node, "c1", "c2", "copies", "least", "n", "sig", "one.*"), "classes")
    families = store(components(candidate_edges(classes)), "families")
    links = store(verified(classes, families, docs, text), "links")
    near = components(links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    slim = classes.select("node", "c1", "c2", "copies", "least", "n")
    joined = slim.join(near, "node", "left").join(counts, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    joined = store(joined, "joined-classes")
    heads = store(joined.groupBy("root").agg(F.min("least").alias("class_id")), "heads")
    named = joined.join(heads, "root")
    # Texts without words are one class without links: there is nothing to compare.
    own = F.when(F.col("n") > 0, F.col("copies") - 1).otherwise(0)
    named = named.select("c1", "c2", "root", "class_id", (F.coalesce("links", F.lit(0)) + own).alias("n_links"), F.col("copies").alias("n_copies"))
    out = rows.select("key", "t", "check", "c1", "c2").join(named, ["c1", "c2"])
    return out.select(F.col("key").alias(key), "t", "check", "root", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component: the least key, then the least text hash.

    Rows that agree in key and text are one document; any one of them stays.
    """
    found = store(join_texts(docs, key, text), "joined")
    chosen = F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("key"), F.col("t").alias("t"), F.col("check").alias("check"))
    winners = found.groupBy("root").agg(F.min(chosen).alias("w")).select("w.key", "w.t", "w.check")
    body = text_of(docs, text)
    packed = docs.select(
        F.col(key).alias("key"), F.xxhash64(body).alias("t"), F.xxhash64(F.lit("second"), body).alias("check"), F.struct("*").alias("row")
    )
    once = packed.groupBy("key", "t", "check").agg(F.first("row").alias("row")).alias("o")
    w = winners.alias("w")
    same = F.col("o.key").eqNullSafe(F.col("w.key")) & (F.col("o.t") == F.col("w.t")) & (F.col("o.check") == F.col("w.check"))
    return once.join(w, same, "left_semi").select("row.*")
