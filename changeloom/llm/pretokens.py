"""Split texts into the pieces a byte-level BPE merges within, a block of texts at a time.

The pieces are those of the public pattern
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
found from character classes instead of a scan. Each different piece is encoded
once and kept in a table of bounded size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

import numpy as np

from changeloom.llm.frames import RangeHash, blocks

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# The white space of the pattern.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Pieces kept per Python worker before the table starts anew.
TABLE_PIECES = 500_000


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)], np.uint8)
    table[WHITE] = SPACE
    return table


@cache
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    other = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(other)}


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text starts (and the end)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return codes, bounds


def piece_starts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces start; no piece spans two texts."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[codes]
    first = np.zeros(n, bool)
    first[bounds[:-1][bounds[:-1] < n]] = True
    turn = first.copy()
    turn[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = codes[:-1] == 32
    after_blank &= ~first
    start = turn & (white | ~after_blank)
    # The last white space before a word stands alone or leads that word.
    start[:-1] |= white[:-1] & ~white[1:] & ~first[1:]
    quote = np.flatnonzero((codes == 39) & turn & ~after_blank)
    if len(quote):
        padded, inside = np.append(codes, [0, 0, 0]), np.append(~first, [False] * 3)
        one, two = quote + 1, quote + 2
        short = inside[one] & np.isin(padded[one], [ord(c) for c in "stmd"])
        pair = padded[one].astype(np.int64) << 32 | padded[two]
        known = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]
        long = inside[one] & inside[two] & np.isin(pair, known)
        start[one[short | long]] = False
        rest = np.concatenate([one[short] + 1, two[long] + 1])
        rest = rest[rest < n]
        start[rest[~first[rest] & (kind[rest] == LETTER)]] = True
    return np.flatnonzero(start)


class PieceTable:
    """Ids of pieces by hash: ordered arrays, a few tens of bytes a piece."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)

    def add(self, keys: np.ndarray, checks: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.checks = np.insert(self.checks, where, checks)
        self.at = np.insert(self.at, where, at)
        self.size = np.insert(self.size, where, size)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and the slot of each."""
        slot = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return np.zeros(len(keys), bool), slot
        slot = np.minimum(slot, len(self.keys) - 1)
        return self.keys[slot] == keys, slot


class PieceEncoder:
    """Ids of texts, from a function that encodes single pieces.

    New pieces go to a small table, which joins the large one when it has RECENT of them.
    """

    RECENT = 40_000

    def __init__(self, encode: Callable[[list[str]], list[Sequence[int]]], limit: int = TABLE_PIECES):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.main, self.recent = PieceTable(), PieceTable()
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        found = self.encode(pieces)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids) // 2, total), np.int32)])
        self.ids[self.used : self.used + total] = np.fromiter((i for f in found for i in f), np.int32, total)
        self.recent.add(keys, checks, self.used + np.cumsum(sizes) - sizes, sizes)
        self.used += total

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is known, and its check, first id and number of ids."""
        out = [np.zeros(len(keys), bool), np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)]
        for table in (self.main, self.recent):
            known, slot = table.find(keys)
            slot = slot[known]
            out[0] |= known
            for values, column in zip(out[1:], (table.checks, table.at, table.size), strict=True):
                values[known] = column[slot]
        return tuple(out)

    def block(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start (and the end)."""
        codes, bounds = code_points(texts)
        starts = piece_starts(codes, bounds)
        ends = np.append(starts[1:], len(codes)) if len(starts) else starts
        key = RangeHash(codes, 0).of(starts, ends)
        check = RangeHash(codes, 1).of(starts, ends)
        different, one, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.recent.keys) > self.RECENT:
            self.main.add(self.recent.keys, self.recent.checks, self.recent.at, self.recent.size)
            self.recent = PieceTable()
        if len(self.main.keys) > self.limit:
            self.clear()
        known, seen, at, size = self._places(different)
        new = np.flatnonzero(~known)
        if len(new):
            joined = "".join(texts)
            pieces = [joined[a:b] for a, b in zip(starts[one[new]], ends[one[new]], strict=True)]
            self._learn(different[new], check[one[new]], pieces)
            _, seen, at, size = self._places(different)
        if not np.array_equal(seen[which], check):
            # Two pieces share a 64-bit hash: encode this block piece by piece.
            joined = "".join(texts)
            found = self.encode([joined[a:b] for a, b in zip(starts, ends, strict=True)])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for f in found for i in f), np.int32, int(sizes.sum()))
        else:
            sizes = size[which]
            total = int(sizes.sum())
            ids = self.ids[np.repeat(at[which] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]
        before = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        return ids, before[np.searchsorted(starts, bounds)]

    def texts(self, texts: Sequence[str], special: dict[str, int]) -> list[np.ndarray]:
        """Ids of each text; the strings of `special` are single tokens."""
        out: list[np.ndarray] = []
        for a, b in blocks([len(t) for t in texts]):
            units, owner, marks = [], [], []
            for i, text in enumerate(texts[a:b]):
                for piece, mark in split_special(text, special):
                    units.append(piece)
                    owner.append(i)
                    marks.append(mark)
            ids, bounds = self.block(units)
            if len(units) == b - a:
                out += [ids[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                continue
            parts: list[list[np.ndarray]] = [[] for _ in range(b - a)]
            for k, i in enumerate(owner):
                parts[i].append(ids[bounds[k] : bounds[k + 1]])
                if marks[k] is not None:
                    parts[i].append(np.array([marks[k]], np.int32))
            out += [np.concatenate(p) for p in parts]
        return out


def split_special(text: str, special: dict[str, int]) -> list[tuple[str, int | None]]:
    """The text between special tokens, each with the id that follows it."""
    rest: list[tuple[str, int | None]] = [(text, None)]
    for word, number in special.items():
        if word in text:
            cut = []
            for piece, mark in rest:
                parts = piece.split(word)
                cut += [(p, number) for p in parts[:-1]] + [(parts[-1], mark)]
            rest = cut
    return rest
