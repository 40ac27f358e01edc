"""Remove text that occurs elsewhere, with sparse suffix arrays.

A byte is removed if it lies in a string of LENGTH bytes that also starts at any
other place of the corpus, in the same text or another. To find those strings
without sorting every suffix, suffixes are sampled by content: the place of the
least hash of GRAM bytes within a string is its anchor, so equal strings have
equal anchors, about 1.2 places per hundred bytes. The strings that share one
anchor form a context.

1. Anchors whose bytes occur once in the corpus end here. If all anchors with the
   same bytes have the same context, every string of it is repeated.
2. The contexts that are left are compared: the suffixes that start at an anchor,
   and those that run backwards from it, are sorted by deep-shallow sorting
   (multikey quicksort down to SHALLOW bytes, blind tries for suffixes that still
   agree), which gives suffix arrays with the lengths of common prefixes. A string
   is repeated where another context shares its part before and after the anchor.
3. Anchors with over GROUP contexts never meet in one task. Their contexts are cut
   into pieces of PIECE starts; a piece whose common bytes occur once ends here,
   one that occurs whole elsewhere is repeated, and only the strings of the others
   are counted one by one. All counts are of 128-bit digests and are combined
   before the shuffle.

Equal texts are one text with a multiplicity, so a group of copies costs one text
per input split. Hash ties only add comparisons in step 2; contexts are told
apart by 128 bits, texts by 128 bits.

Texts are UTF-8 bytes; null is the empty text; texts under LENGTH bytes lose
nothing; repeated rows are copies of each other and all lose everything; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import RangeHash, blocks, mixed, shuffle_partitions, store, text_of, utf8

LENGTH = 200
GRAM = 32
SHALLOW = 48
GROUP = 4096
PIECE = 8
BLOCK = 1 << 18
# Places of an anchor within a string.
REACH = LENGTH - GRAM
# Bits of a packed place: 31 for the first start, 8 for the further starts, 8 for the anchor, 16 of the text's second hash.
SPAN_BITS, ANCHOR_BITS, CHECK_BITS = 8, 8, 16


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours, by running minima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, bounds: np.ndarray):
    """Anchors of all strings: (hash of the anchor, hash of its context, first and last start, place, text)."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    sums = RangeHash(raw, 0)
    n = len(raw)
    starts = np.arange(n - GRAM + 1)
    gram = sums.of(starts, starts + GRAM)
    # Least upper half of the hash first, then leftmost.
    least = sliding_least((gram >> np.uint64(32) << np.uint64(32)) | starts.astype(np.uint64), REACH + 1)
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # A string ends within its text.
    whole = owner[: n - LENGTH + 1] == owner[LENGTH - 1 :]
    at = np.flatnonzero(whole)
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    place = place[at]
    turn = np.concatenate([[True], place[1:] != place[:-1]])
    low, high = at[turn], at[np.append(np.flatnonzero(turn)[1:] - 1, len(at) - 1)]
    place = place[turn]
    shape = ((place - low) * 1024 + (high - low)).astype(np.uint64)
    context = mixed(RangeHash(raw, 1).of(low, high + LENGTH) + mixed(shape + np.uint64(7)))
    return gram[place], context, low, high, place, owner[low]


def pack(low: np.ndarray, high: np.ndarray, anchor: np.ndarray, check: np.ndarray) -> np.ndarray:
    """First start, number of further starts, bytes from the first start to the anchor, some bits of the text's second hash."""
    word = (low << SPAN_BITS) | (high - low)
    word = (word << ANCHOR_BITS) | anchor
    return (word << CHECK_BITS) | own_bits(check)


def own_bits(check: np.ndarray) -> np.ndarray:
    return check & ((1 << CHECK_BITS) - 1)


def unpack(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start, bytes from the first start to the anchor, bits of the text's second hash."""
    low = word >> (SPAN_BITS + ANCHOR_BITS + CHECK_BITS)
    high = low + ((word >> (ANCHOR_BITS + CHECK_BITS)) & ((1 << SPAN_BITS) - 1))
    return low, high, (word >> CHECK_BITS) & ((1 << ANCHOR_BITS) - 1), own_bits(word)


# ---- deep-shallow sorting


def multikey_quicksort(rows: np.ndarray, groups: np.ndarray, depth: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows by (group, bytes from `depth` to `limit`), and segments of rows equal that far.

    Eight bytes are one character. All segments are split around their pivots
    in the same round: lower, equal and higher rows become segments of their own,
    and the equal ones go on to the next character.
    """
    n = len(rows)
    order = np.argsort(groups, kind="stable")
    sorted_groups = groups[order]
    segment = np.cumsum(np.concatenate([[0], (sorted_groups[1:] != sorted_groups[:-1]).astype(np.int64)])) if n else order
    at = np.full(n, depth)
    characters = rows[:, depth:limit].copy().view(">u8").astype(np.uint64) if limit > depth else np.zeros((n, 0), np.uint64)
    while n:
        size = np.bincount(segment)
        first = np.cumsum(size) - size
        active = np.flatnonzero((size[segment] > 1) & (at < limit))
        if not len(active):
            break
        who, where = order[active], segment[active]
        character = characters[who, (at[active] - depth) // 8]
        middle = first[where] + size[where] // 2
        pivot = characters[order[middle], (at[middle] - depth) // 8]
        side = (character > pivot).astype(np.int64) - (character < pivot) + 1
        turn = np.argsort(where * 3 + side, kind="stable")
        order[active] = who[turn]
        at[active] = (at[active] + 8 * (side == 1))[turn]
        label = np.arange(n) * 0 + segment * 3
        label[active] = (where * 3 + side)[turn]
        segment = np.cumsum(np.concatenate([[0], (label[1:] != label[:-1]).astype(np.int64)]))
    return order, segment


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Orders strings with long common prefixes; nodes hold a depth and branch on one byte.

    A string walks down by the bytes at the branching depths alone, is compared
    with the one leaf it reaches, and the length of their common prefix says
    where it belongs. No byte of a common prefix is looked at twice.
    """

    END = -1

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        # A node is [depth, {byte: node}], a leaf the list of its equal strings.
        self.root: list | None = None
        for i in range(len(strings)):
            self.insert(i)

    @classmethod
    def letter(cls, string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else cls.END

    def insert(self, i: int) -> None:
        string = self.strings[i]
        if self.root is None:
            self.root = [None, [i]]
            return
        node, path = self.root, []
        while node[0] is not None:
            path.append(node)
            node = node[1].get(self.letter(string, node[0])) or next(iter(node[1].values()))
        leaf = self.strings[node[1][0]]
        same = shared_prefix(string, leaf)
        if same == len(string) == len(leaf):
            node[1].append(i)
            return
        parent, below = None, self.root
        for inner in path:
            if inner[0] >= same:
                break
            parent, below = inner, inner[1].get(self.letter(string, inner[0]))
        if below is not None and below[0] == same:
            below[1][self.letter(string, same)] = [None, [i]]
            return
        # Any leaf below shares `same` bytes with the one that was reached.
        split = [same, {self.letter(leaf, same): below, self.letter(string, same): [None, [i]]}]
        if parent is None:
            self.root = split
        else:
            parent[1][self.letter(string, parent[0])] = split

    def walk(self) -> tuple[list[int], list[int]]:
        """Strings in order, and the common prefix of each with the one before it."""
        order: list[int] = []
        lengths: list[int] = []
        stack = [(self.root, 0)] if self.root else []
        while stack:
            node, depth = stack.pop()
            if node[0] is None:
                whole = len(self.strings[node[1][0]])
                order += node[1]
                lengths += [depth, *[whole] * (len(node[1]) - 1)]
                continue
            children = sorted(node[1].items())
            for k, (_, child) in reversed(list(enumerate(children))):
                stack.append((child, depth if k == 0 else node[0]))
        return order, lengths


def deep_shallow(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of byte rows within groups, and common prefixes with the one before (-1 at a new group).

    `rows` is padded with zeros beyond `sizes`; prefixes count true bytes only.
    """
    n, width = rows.shape
    limit = min(SHALLOW, width // 8 * 8)
    order, segment = multikey_quicksort(rows, groups, 0, limit)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if n else segment
    last = np.append(first[1:], n)
    prefix = np.zeros(n, np.int64)
    for a, b in zip(first[last - first > 1], last[last - first > 1], strict=True):
        members = order[a:b]
        trie = BlindTrie([rows[i, limit : sizes[i]].tobytes() if sizes[i] > limit else b"" for i in members])
        turn, same = trie.walk()
        order[a:b] = members[turn]
        prefix[a:b] = np.array(same) + limit
    # Between segments the prefix ends within the shallow part.
    heads = first[first > 0]
    if len(heads):
        a, b = order[heads - 1], order[heads]
        different = rows[a, :limit] != rows[b, :limit] if limit else np.zeros((len(heads), 0), bool)
        prefix[heads] = np.where(different.any(1), different.argmax(1), limit) if limit else 0
    if n:
        prefix[1:] = np.minimum(prefix[1:], np.minimum(sizes[order[1:]], sizes[order[:-1]]))
        prefix[0] = -1
        prefix[1:][groups[order[1:]] != groups[order[:-1]]] = -1
    return order, prefix


def repeated_in_group(group: np.ndarray, left: np.ndarray, left_size: np.ndarray, right: np.ndarray, right_size: np.ndarray, near: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
    """For every context the offsets (bytes before the anchor) of its strings that another context has too.

    `near` and `far` are the least and greatest offset of a context's strings.
    """
    n = len(group)
    ahead, ahead_prefix = deep_shallow(right, right_size, group)
    back, back_prefix = deep_shallow(left, left_size, group)
    who, which = [], []
    ahead_class, back_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for offset in range(int(near.min(initial=0)), int(far.max(initial=-1)) + 1):
        members = np.flatnonzero((near <= offset) & (far >= offset))
        if len(members) < 2:
            continue
        ahead_class[ahead] = np.cumsum(ahead_prefix < LENGTH - offset)
        back_class[back] = np.cumsum(back_prefix < offset)
        key = ahead_class[members] * (n + 1) + back_class[members]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = members[counts[inverse] > 1]
        who.append(again)
        which.append(np.full(len(again), offset))
    if not who:
        return [np.zeros(0, np.int64)] * n
    who, which = np.concatenate(who), np.concatenate(which)
    turn = np.argsort(who, kind="stable")
    who, which = who[turn], which[turn]
    cuts = np.searchsorted(who, np.arange(n + 1))
    return [which[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


# ---- the distributed steps


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """Bucketed table of different texts (t, check, body, copies); joins on t do not move them again."""
    spark = docs.sparkSession
    body = text_of(docs, text)
    rows = docs.select(F.xxhash64(body).alias("t"), F.xxhash64(F.lit("second"), body).alias("check"), body.alias("body"))
    different = rows.groupBy("t", "check").agg(F.first("body").alias("body"), F.count("*").alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    different.repartition(shuffle_partitions(spark), "t").write.bucketBy(shuffle_partitions(spark), "t").saveAsTable(name)
    return spark.table(name)


def anchor_rows(texts: DataFrame) -> DataFrame:
    """(h, d, copies, t, place) of every anchor; copies is 2 for any text with more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, check, copies = (batch.column(i).to_numpy() for i in (0, 1, 3))
            raw, bounds = utf8(batch.column(2))
            for a, b in blocks(np.diff(bounds).tolist(), BLOCK):
                ends = bounds[a : b + 1] - bounds[a]
                gram, context, low, high, at, owner = anchors(raw[bounds[a] : bounds[b]], ends)
                text = owner + a
                columns = [
                    pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    pa.array(np.minimum(copies[text], 2).astype(np.int32)),
                    pa.array(t[text]),
                    pa.array(pack(low - ends[owner], high - ends[owner], at - low, check[text])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["h", "d", "copies", "t", "place"])

    source = texts.select("t", "check", "body", "copies").where(F.octet_length("body") >= LENGTH)
    return source.mapInArrow(run, "h long, d long, copies int, t long, place long")


def context_rows(texts: DataFrame, wanted: DataFrame, make: Callable, shape: str) -> DataFrame:
    """What `make` makes of the bytes around the wanted anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, checks, lists = batch.column(2), batch.column(1).to_numpy(), batch.column(3)
            texts_here = batch.column(0).to_numpy()
            for i in range(len(batch)):
                rows = lists[i].values
                h, copies, place = (rows.field(k).to_numpy(zero_copy_only=False) for k in ("h", "copies", "place"))
                low, high, anchor, check = unpack(place)
                own = (check == own_bits(checks[i])) & (high + LENGTH <= len(bodies[i].as_buffer()))
                if own.any():
                    text = texts_here[i], bodies[i].as_buffer()
                    yield make(text, h[own], copies[own], place[own], low[own], high[own], anchor[own])

    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("h", "copies", "place")).alias("rows"))
    joined = texts.join(lists, "t").select("t", "check", F.encode("body", "utf-8").alias("body"), "rows")
    return joined.mapInArrow(run, shape)


PIECES = "h long, h2 long, d long, copies int, t long, place long"
STRINGS = "one long, two long, copies int, t long, place long"
CONTEXT = "h long, copies int, t long, place long, bytes binary"


def contexts(text: tuple[int, pa.Buffer], h, copies, place, low, high, anchor) -> pa.RecordBatch:
    t, body = text
    data = body.to_pybytes()
    regions = [data[a : b + LENGTH] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
    columns = [
        pa.array(h),
        pa.array(copies, pa.int32()),
        pa.array(np.full(len(h), t)),
        pa.array(place),
        pa.array(regions, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["h", "copies", "t", "place", "bytes"])


def pieces(text: tuple[int, pa.Buffer], h, copies, place, low, high, anchor) -> pa.RecordBatch:
    """Pieces of contexts: digest of the bytes common to all strings of the piece, and of all its bytes.

    Pieces are cut at multiples of PIECE bytes before the anchor, so equal strings lie in
    pieces with equal common bytes.
    """
    t, body = text
    raw = np.frombuffer(body, np.uint8)
    one, two = RangeHash(raw, 0), RangeHash(raw, 1)
    at = low + anchor
    far, near = anchor // PIECE, (at - high) // PIECE
    counts = far - near + 1
    row = np.repeat(np.arange(len(h)), counts)
    cut = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + near[row]
    at = at[row]
    first = np.maximum(low[row], at - (cut + 1) * PIECE + 1)
    last = np.minimum(high[row], at - cut * PIECE)
    inner, outer = at - cut * PIECE, at - (cut + 1) * PIECE + 1 + LENGTH
    shape = mixed((cut * 4096 + (at - first) * 16 + (last - first)).astype(np.uint64))
    aside = mixed(cut.astype(np.uint64) + np.uint64(11))
    columns = [
        pa.array((one.of(inner, outer) + aside).view(np.int64)),
        pa.array((two.of(inner, outer) + aside).view(np.int64)),
        pa.array(mixed(two.of(first, last + LENGTH) + shape).view(np.int64)),
        pa.array(copies[row], pa.int32()),
        pa.array(np.full(len(row), t)),
        pa.array(pack(first, last, at - first, own_bits(place)[row])),
    ]
    return pa.RecordBatch.from_arrays(columns, ["h", "h2", "d", "copies", "t", "place"])


def digests(text: tuple[int, pa.Buffer], h, copies, place, low, high, anchor) -> pa.RecordBatch:
    """Digest of every string of the contexts."""
    t, body = text
    raw = np.frombuffer(body, np.uint8)
    sizes = high - low + 1
    start = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    columns = [
        pa.array(RangeHash(raw, 0).of(start, start + LENGTH).view(np.int64)),
        pa.array(RangeHash(raw, 1).of(start, start + LENGTH).view(np.int64)),
        pa.array(np.repeat(copies, sizes), pa.int32()),
        pa.array(np.full(len(start), t)),
        pa.array(pack(start, start, np.zeros_like(start), np.repeat(own_bits(place), sizes))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["one", "two", "copies", "t", "place"])


def compare(rows: DataFrame) -> DataFrame:
    """(t, place) of the strings that contexts with the same anchor share."""

    def batch_of(held: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(held)
        h, copies, t, place = (table.column(i).to_numpy() for i in range(4))
        raw, bounds = utf8(table.column(4).combine_chunks())
        low, high, anchor, check = unpack(place)
        n = len(h)
        size = np.diff(bounds)
        right_size, left_size = size - anchor, anchor
        right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, REACH + 8 - REACH % 8), np.uint8)
        fill(right, raw, bounds[:-1] + anchor, np.minimum(right_size, LENGTH), 1)
        fill(left, raw, bounds[:-1] + anchor - 1, left_size, -1)
        offsets = repeated_in_group(h, left, left_size, right, np.minimum(right_size, LENGTH), anchor - (high - low), anchor)
        out_t, out_place = [], []
        for i in np.flatnonzero(copies < 2):
            if len(offsets[i]):
                starts = np.sort(low[i] + anchor[i] - offsets[i])
                first = starts[np.concatenate([[True], np.diff(starts) > 1])]
                last = starts[np.concatenate([np.diff(starts) > 1, [True]])]
                out_place.append(pack(first, last, np.zeros_like(first), check[i]))
                out_t.append(np.full(len(first), t[i]))
        columns = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (out_t, out_place)]
        return pa.RecordBatch.from_arrays(columns, ["t", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        count = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            count += len(batch)
            if count < 2 * GROUP:
                continue
            table = pa.concat_tables(held)
            h = table.column(0).to_numpy()
            # The last anchor may go on in the next batch.
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                for a, b in whole_groups(h[:cut]):
                    yield batch_of([table.slice(a, b - a)])
            held, count = [table.slice(cut)], count - cut
        if held:
            table = pa.concat_tables(held)
            for a, b in whole_groups(table.column(0).to_numpy()):
                yield batch_of([table.slice(a, b - a)])

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, "t long, place long")


def whole_groups(h: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about 2 x GROUP rows that do not part equal neighbours."""
    if len(h):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sizes = np.diff(np.append(first, len(h)))
        for a, b in blocks(sizes.tolist(), 2 * GROUP):
            yield int(first[a]), int(first[b]) if b < len(first) else len(h)


def fill(table: np.ndarray, raw: np.ndarray, start: np.ndarray, size: np.ndarray, step: int) -> None:
    """Row i of `table` gets size[i] bytes of `raw` from start[i], forwards or backwards."""
    row = np.repeat(np.arange(len(size)), size)
    column = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    table[row, column] = raw[start[row] + step * column]


def settle(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(t, place) that is repeated as a whole, and one row of each context that must be compared.

    `rows` share `keys` if they may have a string in common and `d` if they are
    equal. What is joined is written first, so a crowded key can be split.
    """
    seen = rows.groupBy(*keys).agg(F.sum("copies").alias("size"), F.min("d").alias("d_low"), F.max("d").alias("d_high"))
    same = (F.col("d_low") == F.col("d_high")).alias("same")
    shared = store(seen.where(F.col("size") > 1).select(*keys, same), "shared")
    # Texts with copies lose everything; their anchors are only there to be compared with.
    flagged = store(rows.join(shared, keys).where(~F.col("same") | (F.col("copies") < 2)), "anchors")
    settled = flagged.where(F.col("same")).select("t", "place")
    unsettled = flagged.where(~F.col("same"))
    different = unsettled.groupBy(*keys, "d").agg(F.sum("copies").alias("copies"), F.min(F.struct("t", "place")).alias("one"))
    different = store(different.select(*keys, "d", F.least("copies", F.lit(2)).cast("int").alias("copies"), "one.*"), "contexts")
    twice = different.where(F.col("copies") > 1).select(*keys, "d")
    again = unsettled.where(F.col("copies") < 2).join(twice, [*keys, "d"]).select("t", "place")
    return settled.unionByName(again), different


def repeated(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The table of different texts, and (t, place) of their repeated strings."""
    texts = distinct_texts(docs, text)
    settled, different = settle(anchor_rows(texts), ["h"])
    crowded = store(different.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("h"), "crowded")
    small = different.join(crowded, "h", "left_anti")
    parts = [settled, compare(context_rows(texts, small, contexts, CONTEXT))]
    if not crowded.isEmpty():
        crowd = different.join(crowded, "h", "left_semi")
        cut = store(context_rows(texts, crowd, pieces, PIECES), "pieces")
        whole, open_ = settle(cut, ["h", "h2"])
        strings = store(context_rows(texts, open_, digests, STRINGS), "strings")
        counts = strings.groupBy("one", "two").agg(F.sum("copies").alias("n")).where(F.col("n") > 1)
        found = strings.where(F.col("copies") < 2).join(store(counts, "counts"), ["one", "two"])
        parts += [whole, found.select("t", "place")]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return texts, found


REMOVED = "t long, check long, n_bytes long, n_removed long, runs array<long>, kept_sha256 string"


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", content: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, runs, kept_sha256) of every row; `content` adds the bytes kept.

    `runs` are the removed runs as start, end, start, end ...
    """
    texts, found = repeated(docs, text)
    places = found.groupBy("t").agg(F.collect_list("place").alias("places"))
    joined = texts.join(places, "t", "left").select("t", "check", F.encode("body", "utf-8").alias("body"), "copies", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            checks, copies = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            sizes, removed, runs, hashes, kept = [], [], [], [], []
            for i in range(len(batch)):
                body = batch.column(2)[i].as_buffer().to_pybytes()
                places = batch.column(4)[i]
                if copies[i] > 1 and len(body) >= LENGTH:
                    cut = np.array([[0, len(body)]])
                elif places.is_valid:
                    low, high, _, check = unpack(places.values.to_numpy())
                    own = check == own_bits(checks[i])
                    cut = joined_runs(low[own], high[own] + LENGTH)
                else:
                    cut = np.zeros((0, 2), np.int64)
                rest, at = [], 0
                for a, b in cut.tolist():
                    rest.append(body[at:a])
                    at = b
                rest = b"".join([*rest, body[at:]])
                sizes.append(len(body))
                removed.append(len(body) - len(rest))
                runs.append(cut.ravel().tolist())
                hashes.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.list_(pa.int64())),
                pa.array(hashes, pa.string()),
            ]
            names = ["t", "check", "n_bytes", "n_removed", "runs", "kept_sha256"]
            if content:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    results = joined.mapInArrow(run, REMOVED + (", kept binary" if content else ""))
    body = text_of(docs, text)
    rows = docs.select(F.col(key).alias(key), F.xxhash64(body).alias("t"), F.xxhash64(F.lit("second"), body).alias("check"))
    return rows.join(results, ["t", "check"]).drop("t", "check")


def joined_runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs covered by [start, end) ranges."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    turn = np.argsort(starts, kind="stable")
    starts, ends = starts[turn], np.maximum.accumulate(ends[turn])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return np.stack([starts[new], np.append(ends[:-1][new[1:]], ends[-1])], 1)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256)."""
    rows = dedupe(docs, key, text)
    return rows.select(key, "n_bytes", "n_removed", (F.size("runs") / 2).cast("long").alias("n_spans"), "kept_sha256")
