"""BPE encoding and decoding as streams of constant memory.

The encoder is a transducer with bounded lookahead. From the merge list alone it
computes how many bytes beyond a place can still decide whether a merge before
that place happens; a token is emitted as soon as that many bytes follow it. The
decoder is a state machine from bytes to text that holds back an unfinished
character only.

Nulls are empty texts and have no ids; repeated rows and ties are encoded one by
one, so their rows repeat; an empty table gives an empty result; any other
columns of the input are ignored. A text of any length is encoded whole.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import blocks, text_of
from changeloom.llm.pretokens import PieceEncoder, byte_letters

# Bytes the transducer takes in before it looks for stable tokens: a few times the lookahead, so that
# a byte is merged little more than once.
CHUNK = 8192
# Bytes up to which merging scans all pairs; longer portions keep their pairs in a heap.
SHORT = 48


class Merges:
    """A byte-level merge list: bytes of every token, rank and result of every pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes = {i: spell(t) for t, i in vocab.items() if t not in self.special}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        by_bytes = {b: i for i, b in self.bytes.items()}
        self.single = [by_bytes[bytes([b])] for b in range(256)]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[a], vocab[b]
            self.ranks.setdefault(pair, (rank, vocab[a + b]))
            self.parts.setdefault(vocab[a + b], pair)
        self.longest = max(len(self.bytes[i]) for i in self.parts) if self.parts else 1

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens in a row, and the bounds of each id."""
        sizes = np.zeros(max(self.bytes) + 2, np.int64)
        for i, b in self.bytes.items():
            sizes[i + 1] = len(b)
        flat = b"".join(self.bytes[i] for i in sorted(self.bytes))
        return np.frombuffer(flat, np.uint8), np.cumsum(sizes)

    def lookahead(self) -> int:
        """Bytes after a token that can still decide whether it stands.

        A merge (a, b) is undone only by an earlier merge that takes the right
        end of b away: one whose left part is b or a right end of b. That merge
        may itself be undone in the same way further to the right, always by a
        yet earlier one, so the reach of a merge follows from those before it.
        """
        reach_of_left: dict[int, int] = {}
        most = 0
        for (a, b), (_, _) in sorted(self.ranks.items(), key=lambda x: x[1][0]):
            reach, end = 0, b
            while True:
                reach = max(reach, reach_of_left.get(end, 0))
                if end not in self.parts:
                    break
                end = self.parts[end][1]
            most = max(most, reach)
            reach_of_left[a] = max(reach_of_left.get(a, 0), reach + len(self.bytes[b]))
        return most + max(reach_of_left.values(), default=0) + self.longest


class Transducer:
    """Token ids of one piece, fed in any portions."""

    def __init__(self, merges: Merges, lookahead: int | None = None):
        self.merges = merges
        self.lookahead = merges.lookahead() if lookahead is None else lookahead
        self.held: list[int] = []
        self.held_bytes = 0

    def feed(self, portion: bytes) -> Iterator[int]:
        """Take bytes in; emit the tokens that are stable by now."""
        for at in range(0, len(portion), CHUNK):
            part = portion[at : at + CHUNK]
            self.held.extend(part)
            if len(self.held) > self.lookahead + CHUNK:
                yield from self._emit(len(self.held) - self.lookahead)

    def finish(self) -> Iterator[int]:
        """The piece ends here: what is held is stable."""
        yield from self._emit(len(self.held))

    def _emit(self, stable: int) -> Iterator[int]:
        done = 0
        for token in merge(self.merges, self.held):
            size = len(self.merges.bytes[token])
            if done + size > stable:
                break
            done += size
            yield token
        del self.held[:done]


def merge(merges: Merges, portion: Iterable[int]) -> list[int]:
    """Apply the merge list to bytes: earliest merge first, leftmost first."""
    ids = [merges.single[b] for b in portion]
    return merge_short(merges.ranks, ids) if len(ids) <= SHORT else merge_long(merges.ranks, ids)


def merge_short(ranks: dict[tuple[int, int], tuple[int, int]], ids: list[int]) -> list[int]:
    """Merges one by one, all places of a merge in one pass."""
    none = (1 << 60, 0)
    while len(ids) > 1:
        best, pair = none, None
        for p in zip(ids, ids[1:]):  # noqa: B905
            found = ranks.get(p, none)
            if found < best:
                best, pair = found, p
        if pair is None:
            break
        out, i, n = [], 0, len(ids)
        while i < n:
            if i + 1 < n and ids[i] == pair[0] and ids[i + 1] == pair[1]:
                out.append(best[1])
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out
    return ids


def merge_long(ranks: dict[tuple[int, int], tuple[int, int]], ids: list[int]) -> list[int]:
    """The same from a heap of (rank, place) over linked ids: a pair is looked at when it forms and when its turn comes."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(found[0], i) for i, pair in enumerate(zip(ids, ids[1:])) if (found := ranks.get(pair))]  # noqa: B905
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        # Since then one of the two may have gone into another merge.
        found = ranks.get((ids[i], ids[j])) if ids[i] >= 0 and j < n else None
        if found is None or found[0] != rank:
            continue
        ids[i], ids[j] = found[1], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if new := ranks.get((ids[i], ids[k])):
                heapq.heappush(heap, (new[0], i))
        h = before[i]
        if h >= 0 and (new := ranks.get((ids[h], ids[i]))):
            heapq.heappush(heap, (new[0], h))
    return [x for x in ids if x >= 0]


class ByteToText:
    """Text from token bytes in portions; broken bytes become U+FFFD."""

    def __init__(self):
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, portion: bytes) -> str:
        return self.state.decode(portion)

    def finish(self) -> str:
        return self.state.decode(b"", True)


class Codec:
    """Encoder and decoder of one vocabulary file, kept per Python worker."""

    _kept: dict = {}

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.reach = self.merges.lookahead()
        self.flat, self.bounds = self.merges.table
        self.encoder = PieceEncoder(self._pieces)

    @classmethod
    def at(cls, path: str) -> Codec:
        if path not in cls._kept:
            cls._kept = {path: cls(path)}
        return cls._kept[path]

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        out = []
        for piece in pieces:
            machine = Transducer(self.merges, self.reach)
            out.append([*machine.feed(piece.encode()), *machine.finish()])
        return out

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return self.encoder.texts(texts, self.merges.special)

    def decode(self, ids: np.ndarray, portion: int = 1 << 15) -> Iterator[str]:
        """Text of ids, in portions of bounded size."""
        machine = ByteToText()
        for at in range(0, len(ids), portion):
            part = ids[at : at + portion]
            starts = self.bounds[part]
            sizes = self.bounds[part + 1] - starts
            before = np.cumsum(sizes) - sizes
            where = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
            yield machine.feed(self.flat[where].tobytes())
        yield machine.finish()


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.at(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks([len(t) for t in texts]):
                ids = codec.encode(texts[a:b])
                column = pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column], ["key", "ids"])

    source = docs.select(F.col(id_col).alias("key"), text_of(docs, text_col).alias("body"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", id_col)


def decode_documents(coded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of every array of ids; null and empty arrays are empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.at(path)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = ["".join(codec.decode(np.array(r or [], np.int64))) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "body"])

    source = coded.select(F.col(id_col).alias("key"), F.col("ids"))
    kind = source.schema["key"].dataType.simpleString()
    decoded = source.mapInArrow(run, f"key {kind}, body string")
    return decoded.select(F.col("key").alias(id_col), F.col("body").alias("text"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded, then decoded from its ids.

    Ids are hashed as little-endian unsigned 32-bit integers; the decoded text
    is hashed portion by portion. `ids` adds the ids themselves, in that form.
    """
    with_ids = ids
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.at(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, id_hashes, text_hashes, raws = [], [], [], []
            for a, b in blocks([len(t) for t in texts]):
                for ids in codec.encode(texts[a:b]):
                    counts.append(len(ids))
                    raw = ids.astype("<u4").tobytes()
                    id_hashes.append(hashlib.sha256(raw).hexdigest())
                    if with_ids:
                        raws.append(raw)
                    digest = hashlib.sha256()
                    for portion in codec.decode(ids):
                        digest.update(portion.encode())
                    text_hashes.append(digest.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(raws, pa.binary())] if with_ids else [])], names)

    source = docs.select(F.col(id_col).alias("key"), text_of(docs, text_col).alias("body"))
    kind = source.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else "")
    out = source.mapInArrow(run, shape)
    return out.withColumnRenamed("key", id_col)
