"""Periodic runs of words, from suffix classes united by decreasing common prefix.

A run is a stretch with smallest period q that no neighbouring word extends and that
is at least LEAST_LENGTH words and LEAST_PERIODS periods long. Two suffixes that
start a period apart in it share a prefix of its length less q, so a run of that size
needs a common prefix of `least_prefix` words; only word positions whose window of that
length returns in the same text can matter. Those are found by window hashes, sorted by
their windows and put in suffix order by prefix doubling; prefixes common to neighbours
follow from the ranks of the doubling.

Neighbours are then united as by Kruskal, longest common prefix first. Every class keeps
its positions in order, the smaller class is put into the larger, and two positions i < j
that become neighbours in a class at a common prefix of at least j - i words are a square
seed: where the words before them differ, [i, j + prefix) is a run with smallest period
j - i. (With a smaller period another position between them would be in the class.)
Every run is seeded exactly once, by its first word and the word one period on.

Texts are cut into words without white space (blank, tab to carriage return). A null or
empty text has no words and no runs. Repeated rows are treated one by one; an empty table
gives no rows; other columns are ignored. A text is never split: a long one needs about 200
bytes a word in its task, and time in proportion to n log n however often a word returns.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import RangeHash, blocks, mixed, text_of

LEAST_LENGTH = 24
LEAST_PERIODS = 3
# Bytes of text whose words are looked at together.
BLOCK_BYTES = 1 << 20
# Positions in one list of an ordered set.
LOAD = 2048

Run = tuple[int, int, int]  # first word, words, period


def least_prefix(length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> int:
    """Words that two suffixes one period apart share at least at the start of a run."""
    return min(max(length - q, (periods - 1) * q) for q in range(1, length + 1))


class Positions:
    """An ordered set of numbers, in short sorted lists."""

    __slots__ = ("lists", "size")

    def __init__(self, first: int):
        self.lists, self.size = [[first]], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.lists:
            yield from part

    def _list(self, x: int) -> int:
        """The list that x belongs to."""
        return 0 if len(self.lists) == 1 else max(bisect_right(self.lists, [x]) - 1, 0)

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The numbers next to x, which is not in the set."""
        k = self._list(x)
        part = self.lists[k]
        at = bisect_left(part, x)
        before = part[at - 1] if at else None
        if at < len(part):
            return before, part[at]
        return before, self.lists[k + 1][0] if k + 1 < len(self.lists) else None

    def add(self, x: int) -> None:
        k = self._list(x)
        part = self.lists[k]
        insort(part, x)
        self.size += 1
        if len(part) > LOAD:
            self.lists[k : k + 1] = [part[: LOAD // 2], part[LOAD // 2 :]]


def united(small: Positions, large: Positions) -> Iterator[tuple[int, int]]:
    """Put `small` into `large`; the pairs from both that are neighbours afterwards."""
    members = list(small)
    for k, x in enumerate(members):
        before, after = large.around(x)
        # `before` may be a member put in already: then that pair is not new.
        if before is not None and not (k and before == members[k - 1]):
            yield before, x
        if after is not None and not (k + 1 < len(members) and members[k + 1] < after):
            yield x, after
        large.add(x)


def square_seeds(order: Sequence[int], shared: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, prefix) with j - i <= prefix, from positions in suffix order and the prefixes of neighbours."""
    sets = [Positions(p) for p in order]
    parent = list(range(len(order)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in sorted(range(len(shared)), key=shared.__getitem__, reverse=True):
        prefix, a, b = shared[k], root(k), root(k + 1)
        if sets[a].size > sets[b].size:
            a, b = b, a
        for i, j in united(sets[a], sets[b]):
            if j - i <= prefix:
                yield i, j, prefix
        parent[a], sets[a] = b, None


def returning(ids: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Positions whose window of `least` ids may return in the same text, and those `least` behind them.

    `ids` ends every text with a number of its own, so no window that returns spans two. Equal
    windows have equal hashes; that different ones may as well only adds positions.
    """
    n = len(ids) - least + 1
    if n < 2:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    keys = RangeHash(ids).of(at, at + least) ^ mixed(owner[:n].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
    order = order[same[1:] | same[:-1]]
    behind = order + least
    return np.unique(np.concatenate([order, behind[behind < len(ids)]]))


def window_order(ids: np.ndarray, owner: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions `at` in order of text and window, and for each place the first place with the same ones."""
    bits = max(int(ids.max()).bit_length(), 1)
    per = max(1, min(least, 63 // bits))
    padded = np.concatenate([ids, np.zeros(least + per, np.int64)])
    columns = []
    for k in range(0, least, per):
        packed = np.zeros(len(at), np.int64)
        for x in range(k, min(k + per, least)):
            packed = packed << bits | padded[at + x]
        columns.append(packed)
    columns = [owner[at], *columns]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(at), bool)
    new[:1] = True
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return at[order], np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))


def suffix_order(ids: np.ndarray, order: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions in suffix order, and the prefix each shares with the one after it.

    `order` and `first` come from `window_order`; ranks of longer prefixes refine those of windows.
    """
    n = len(order)
    rank = np.arange(n, n + len(ids), dtype=np.int64)
    rank[order] = first
    order, levels, length = order.copy(), [rank.astype(np.int32 if n + len(ids) < 1 << 31 else np.int64)], least
    while True:
        held = rank[order]
        size = np.bincount(held, minlength=n)
        open_ = np.flatnonzero(size[held] > 1)
        if not len(open_):
            break
        follow = rank[order[open_] + length]
        moved = np.lexsort((follow, held[open_]))
        a, b = held[open_][moved], follow[moved]
        order[open_] = order[open_][moved]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        levels.append(rank.astype(levels[0].dtype))
        length *= 2
    left, right, shared = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][left + shared] == levels[k][right + shared]
        shared[equal] += least << k
    rest = np.flatnonzero(shared >= least)
    for _ in range(least - 1):
        rest = rest[ids[left[rest] + shared[rest]] == ids[right[rest] + shared[rest]]]
        if not len(rest):
            break
        shared[rest] += 1
    return order, shared


def runs_of(texts: Sequence[Sequence[bytes]], length: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> list[list[Run]]:
    """The runs of every text, by first word and period."""
    least = least_prefix(length, periods)
    # Every text ends with a number that no word has.
    ends = count()
    numbers: dict[bytes, int] = defaultdict(ends.__next__)
    parts, sizes = [], np.array([len(words) + 1 for words in texts], np.int64)
    for words in texts:
        parts += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.array([next(ends)])]
    found: list[list[Run]] = [[] for _ in texts]
    if not parts:
        return found
    ids, owner = np.concatenate(parts), np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    at = returning(ids, owner, least)
    if not len(at):
        return found
    order, shared = suffix_order(ids, *window_order(ids, owner, at, least), least)
    # One class per window that returns; a class whose positions are all further apart than they agree has no run.
    borders = np.flatnonzero(np.concatenate([[True], shared < least, [True]]))
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        inside, prefixes = order[a:b], shared[a : b - 1]
        if b - a < 2 or np.diff(np.sort(inside)).min() > prefixes.max():
            continue
        text = int(owner[inside[0]])
        start = int(starts[text])
        for i, j, prefix in square_seeds(inside.tolist(), prefixes.tolist()):
            period, size = j - i, j - i + prefix
            if size >= max(length, periods * period) and (i == start or ids[i - 1] != ids[j - 1]):
                found[text].append((i - start, size, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def highest(runs: Sequence[Run]) -> Run | None:
    """The run with most periods; of equal ones the first, then the shortest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> Sequence[bytes]:
    """The words that no run contains behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def listed(runs: Sequence[Run]) -> bytes:
    return b"".join(b"%d,%d,%d\n" % run for run in runs)


Change = Callable[[Sequence[int | None], list[list[bytes]]], list[list[bytes]]]
def planted(keys: Sequence[int | None], texts: list[list[bytes]]) -> list[list[bytes]]:
    """Make the end of about one text in ten periodic, by the hash of its key; a text without key stays."""
    out = []
    for key, words in zip(keys, texts, strict=True):
        h, n = crc32(b"%d" % key) if key is not None else 1, len(words)
        if h % 10 == 0 and n:
            g = h // 10
            start = g % n
            period = 1 + (n - start) // (3 + g % 8)
            words = words[:start] + [words[start + i % period] for i in range(n - start)]
        out.append(words)
    return out


SHAPE = (
    "{key} {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, {more}"
)


def report(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    change: Change | None = None,
    length: int = LEAST_LENGTH,
    periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Per row the number of runs, the run with most periods, and hashes of all runs and of the words left.

    Also `n_words` and `n_kept`. `change` may alter the words of a block of texts first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bodies = batch.column(0), batch.column(1).cast(pa.binary())
            for a, b in blocks([len(body.as_buffer()) for body in bodies], BLOCK_BYTES):
                texts = [body.split() for body in bodies.slice(a, b - a).to_pylist()]
                if change:
                    texts = change(keys.slice(a, b - a).to_pylist(), texts)
                rows = []
                for words, runs in zip(texts, runs_of(texts, length, periods), strict=True):
                    best, left = highest(runs), collapsed(words, runs)
                    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                    digests = [hashlib.sha256(x).hexdigest() for x in (listed(runs), b" ".join(left))]
                    rows.append((len(runs), *shown, *digests, len(words), len(left)))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), *columns], names)

    shape = SHAPE.format(key="_key", kind=docs.schema[key].dataType.simpleString(), more="n_words long, n_kept long")
    names = [part.split()[0] for part in shape.split(", ")]
    rows = docs.select(F.col(key).alias("_key"), text_of(docs, text).alias("_text"))
    return rows.mapInArrow(run, shape).withColumnRenamed("_key", key)
