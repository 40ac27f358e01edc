"""Benchmark decontamination with suffix arrays over the training texts.

Training texts are read in shards, one block of rows inside a task at a time.
Each shard has a suffix array over its words; every suffix of the benchmark
is searched in it by bisection, which gives all places of its window and, for every
place, the two benchmark suffixes next to it in order, one of which is its longest
verbatim match. A match of three words or a window needs consecutive words that also
follow each other in the benchmark, so the array holds just those places; a known
word is a match of one, a linked pair a match of two.

Words are runs of digits, letters a to z after lower-casing A to Z, and bytes
beyond ASCII. A window is WINDOW consecutive words of an item; a shorter item
with words is one window. A null text has no words. Repeated documents give
repeated rows; repeated items count once per item id (a null id is named
"null"); empty tables give no hits, or no rows. Other columns are ignored by
`contamination` and kept by `remove`.

The benchmark is held by the tasks in blocks of at most ITEM_BLOCK_BYTES of
text, whatever its size; each further block is one more pass over the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import RangeHash, blocks, store, text_of, utf8

WINDOW = 13
# A document is contaminated if at least 1/SHARE of its words are hit.
SHARE = 20
# An indexed block takes about 140 times its bytes on the driver.
ITEM_BLOCK_BYTES = 4 << 20
SHARD_BYTES = 1 << 19


def _letters() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


LETTERS = _letters()


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every word of all texts, its text, and word counts per text."""
    low = LETTERS[raw]
    n, docs = len(low), len(bounds) - 1
    inside = low > 0
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    one, two = RangeHash(low, 0).of(starts, ends), RangeHash(low, 1).of(starts, ends)
    counts = np.diff(np.searchsorted(starts, bounds))
    return one, two, np.repeat(np.arange(docs), counts), counts


@dataclass(frozen=True)
class Tests:
    """Words of benchmark items as ids from 1, items divided by 0, and their windows."""

    keys: np.ndarray
    checks: np.ndarray
    ids: np.ndarray
    pairs: np.ndarray
    singles: np.ndarray
    # One place per different window, its length, and the items that have it.
    places: np.ndarray
    lengths: np.ndarray
    owners: list[list[str]]
    # Places of all words in the order of the suffixes that start there.
    suffixes: np.ndarray

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def index_items(items: list[tuple[str, str]], window: int = WINDOW) -> Tests:
    raws = [t.encode() for _, t in items]
    bounds = np.cumsum([0, *map(len, raws)])
    one, two, owner, counts = words(np.frombuffer(b"".join(raws), np.uint8), bounds)
    keys, first, ids = np.unique(one, return_index=True, return_inverse=True)
    starts = np.cumsum(counts) - counts
    row: list[np.ndarray] = [np.zeros(1, np.int64)]
    found: dict[bytes, tuple[int, int, set[str]]] = {}
    at = 1
    for i, (name, _) in enumerate(items):
        mine = ids[starts[i] : starts[i] + counts[i]] + 1
        length = min(window, len(mine))
        for k in range(len(mine) - length + 1 if length else 0):
            content = mine[k : k + length].tobytes()
            found.setdefault(content, (at + k, length, set()))[2].add(name)
        row += [mine, np.zeros(1, np.int64)]
        at += len(mine) + 1
    sequence = np.concatenate(row)
    base = len(keys) + 1
    both = (sequence[:-1] > 0) & (sequence[1:] > 0)
    pairs = np.unique((sequence[:-1] * base + sequence[1:])[both])
    singles = np.array([sequence[p] for p, n, _ in found.values() if n == 1], np.int64)
    places = np.array([p for p, _, _ in found.values()], np.int64)
    lengths = np.array([n for _, n, _ in found.values()], np.int64)
    ordered = suffix_array(sequence)
    ordered = ordered[sequence[ordered] > 0]
    return Tests(keys, two[first], sequence, pairs, singles, places, lengths, [sorted(o) for _, _, o in found.values()], ordered)


def contains(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in an ordered array, and its place there."""
    where = np.searchsorted(ordered, values)
    if not len(ordered):
        return np.zeros(len(values), bool), where
    where = np.minimum(where, len(ordered) - 1)
    return ordered[where] == values, where


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Places of a sequence in the order of the suffixes that start there (prefix doubling)."""
    n = len(sequence)
    _, rank = np.unique(sequence, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while n and step < n:
        behind = np.full(n, -1, np.int64)
        behind[: n - step] = rank[step:]
        key = rank * (n + 1) + behind + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        rank = new
        if new.max() == n - 1:
            break
        step *= 2
    return order


def common(shard: np.ndarray, at: np.ndarray, tests: np.ndarray, places: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words of shard[at...] and tests[places...], up to `most`, never across a 0."""
    length = np.zeros(len(at), np.int64)
    active = np.flatnonzero(most > 0)
    depth = 0
    while len(active):
        p, q = at[active] + depth, places[active] + depth
        inside = (p < len(shard)) & (q < len(tests))
        same = np.zeros(len(active), bool)
        same[inside] = (shard[p[inside]] == tests[q[inside]]) & (shard[p[inside]] > 0)
        active = active[same]
        length[active] += 1
        depth += 1
        active = active[most[active] > depth]
    return length


def bisect(shard: np.ndarray, order: np.ndarray, tests: np.ndarray, places: np.ndarray, most: np.ndarray, right: bool) -> np.ndarray:
    """Where the suffixes of `shard` that start with (or lie above) tests[place : place + most] begin or end."""
    low, high = np.zeros(len(places), np.int64), np.full(len(places), len(order), np.int64)
    while len(active := np.flatnonzero(low < high)):
        middle = (low[active] + high[active]) // 2
        at, q, m = order[middle], places[active], most[active]
        same = common(shard, at, tests, q, m)
        p, t = at + same, q + same
        mine = np.where(p < len(shard), shard[np.minimum(p, len(shard) - 1)], -1)
        theirs = np.where(t < len(tests), tests[np.minimum(t, len(tests) - 1)], -1)
        full = same >= m
        below = np.where(full, right, mine < theirs)
        low[active] = np.where(below, middle + 1, low[active])
        high[active] = np.where(below, high[active], middle)
    return low


def search(tests: Tests, one: np.ndarray, two: np.ndarray, owner: np.ndarray):
    """Matches in one shard: (first word, window number) arrays and (word, longest match) arrays."""
    none = np.zeros(0, np.int64)
    if not len(one) or not len(tests.places):
        return (none, none), (none, none)
    known, where = contains(tests.keys, one)
    ids = np.where(known & (tests.checks[where] == two), where + 1, 0)
    base = len(tests.keys) + 1
    link = np.zeros(len(ids), bool)
    link[:-1], _ = contains(tests.pairs, ids[:-1] * base + ids[1:])
    link[:-1] &= (owner[:-1] == owner[1:]) & (ids[:-1] > 0) & (ids[1:] > 0)
    known, pair = np.flatnonzero(ids > 0), np.flatnonzero(link)
    sure = np.concatenate([known, pair]), np.repeat([1, 2], [len(known), len(pair)])
    # Runs of linked words that can hold a window or a match of three words.
    start = link & ~np.concatenate([[False], link[:-1]])
    begins = np.flatnonzero(start)
    stops = np.flatnonzero(link & ~np.concatenate([link[1:], [False]])) + 2
    enough = stops - begins >= max(2, min(3, tests.shortest))
    begins, stops = begins[enough], stops[enough]
    if len(tests.singles):
        alone = np.flatnonzero(contains(np.unique(tests.singles), ids)[0] & (ids > 0))
        covered = np.zeros(len(ids) + 1, np.int64)
        np.add.at(covered, begins, 1)
        np.add.at(covered, stops, -1)
        alone = alone[np.cumsum(covered)[alone] == 0]
        begins, stops = np.concatenate([begins, alone]), np.concatenate([stops, alone + 1])
        turn = np.argsort(begins, kind="stable")
        begins, stops = begins[turn], stops[turn]
    if not len(begins):
        return (none, none), sure
    sizes = stops - begins + 1
    ahead = np.cumsum(sizes) - sizes
    position = np.repeat(begins - ahead, sizes) + np.arange(int(sizes.sum()))
    shard = ids[np.minimum(position, len(ids) - 1)].astype(np.int64)
    shard[ahead + sizes - 1] = 0
    order = suffix_array(shard)
    low = bisect(shard, order, tests.ids, tests.places, tests.lengths, False)
    high = bisect(shard, order, tests.ids, tests.places, tests.lengths, True)
    counts = high - low
    number = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    matched = order[low[number] + within]
    # The benchmark suffixes next to every place in order: one of them is its longest match.
    suffixes = tests.suffixes
    gaps = bisect(shard, order, tests.ids, suffixes, np.full(len(suffixes), len(tests.ids)), False)
    above = np.searchsorted(gaps, np.arange(len(order)), side="right")
    most, best = np.full(len(order), len(shard)), np.zeros(len(order), np.int64)
    for side in (above - 1, above):
        near = suffixes[np.clip(side, 0, len(suffixes) - 1)]
        best = np.maximum(best, common(shard, order, tests.ids, near, most))
    some = best > 2
    far = np.concatenate([sure[0], position[order[some]]])
    return (position[matched], number), (far, np.concatenate([sure[1], best[some]]))


def merged_runs(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Disjoint [start, end) runs that cover the same words, as one flat list."""
    if not len(starts):
        return []
    turn = np.argsort(starts, kind="stable")
    starts, ends = starts[turn], np.maximum.accumulate(ends[turn])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    stop = np.concatenate([ends[:-1][new[1:]], ends[-1:]])
    return np.stack([starts[new], stop], 1).ravel().tolist()


STATE = "runs array<long>, items array<string>, longest long"


def item_blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Different benchmark items in blocks of about `limit` bytes; only one block is on the driver at a time."""
    slim = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("name"), text_of(benchmark, text).alias("body"))
    # Repeated rows would share a block.
    slim = slim.dropDuplicates(["name", "body"])
    total = slim.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    number = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("name", "body"), F.lit(number))
    for k in range(number):
        yield [(r.name, r.body) for r in slim.where(part == k).collect()]


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """Per document: key, n_words, runs of hit words, ids of the items hit, longest match in words."""
    empty = [F.array().cast("array<long>").alias("runs"), F.array().cast("array<string>").alias("items")]
    state = docs.select(F.col(key).alias("key"), text_of(docs, text).alias("body"), *empty, F.lit(0).cast("long").alias("longest"))
    kind = state.schema["key"].dataType.simpleString()
    parts = item_blocks(benchmark, item, item_text, block_bytes)
    held = next(parts)
    while held is not None:
        following = next(parts, None)
        last = following is None
        shape = f"key {kind}, {'n_words long' if last else 'body string'}, {STATE}"
        state = state.mapInArrow(_pass(index_items(held, window), state, last), shape)
        if not last:
            state = store(state, "benchmark-pass")
        held = following
    return state.withColumnRenamed("key", key)


def _pass(tests: Tests, state: DataFrame, last: bool):
    shared = state.sparkSession.sparkContext.broadcast(tests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = utf8(batch.column(1))
            for a, b in blocks(np.diff(bounds).tolist(), SHARD_BYTES):
                rows = batch.slice(a, b - a)
                yield one_shard(shared.value, rows, raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], last)

    return run


def one_shard(tests: Tests, rows: pa.RecordBatch, raw: np.ndarray, bounds: np.ndarray, last: bool) -> pa.RecordBatch:
    one, two, owner, counts = words(raw, bounds)
    (at, number), (far, longest) = search(tests, one, two, owner)
    n = len(bounds) - 1
    ahead = np.cumsum(counts) - counts
    runs, items, most = rows.column(2).to_pylist(), rows.column(3).to_pylist(), np.array(rows.column(4).to_pylist(), np.int64)
    if len(far):
        np.maximum.at(most, owner[far], longest)
    if len(at):
        turn = np.argsort(owner[at], kind="stable")
        at, number = at[turn], number[turn]
        who, first = np.unique(owner[at], return_index=True)
        for i, lo, hi in zip(who, first, np.append(first[1:], len(at)), strict=True):
            old = np.array(runs[i], np.int64).reshape(-1, 2)
            starts = at[lo:hi] - ahead[i]
            ends = starts + tests.lengths[number[lo:hi]]
            runs[i] = merged_runs(np.concatenate([old[:, 0], starts]), np.concatenate([old[:, 1], ends]))
            names = {name for w in np.unique(number[lo:hi]) for name in tests.owners[w]}
            items[i] = sorted({*items[i], *names})
    columns = [
        rows.column(0),
        pa.array(counts, pa.int64()) if last else rows.column(1),
        pa.array(runs, pa.list_(pa.int64())),
        pa.array(items, pa.list_(pa.string())),
        pa.array(most[:n], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "n_words" if last else "body", "runs", "items", "longest"])


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    """Add n_hit, n_items, items_sha256 and contaminated to rows of `hits`."""
    # Runs are start, end, start, end ...: ends count up, starts count down.
    signed = F.transform("runs", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)
    rows = found.withColumn("n_hit", n_hit)
    return rows.withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(F.array_join("items", ","), 256),
            "contaminated": (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")),
        }
    )


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, longest match in words, places.

    `places` are the runs of hit words as start, end, start, end ..., words from 0, ends exclusive.
    """
    rows = judged(hits(docs, benchmark, key, **options)).withColumnRenamed("runs", "places")
    return rows.select(key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "places")


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` without contaminated documents, all columns kept; no shuffle."""
    packed = docs.select(F.struct("*").alias("row"), text_of(docs, text).alias("text"))
    rows = judged(hits(packed, benchmark, "row", "text", **options))
    return rows.where(~F.col("contaminated")).select("row.*")
