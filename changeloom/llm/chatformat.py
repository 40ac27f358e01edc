"""Chat formatting: speaker roles by a hidden Markov model, then canonical turns.

A transcript is the rows of a conversation in the order of their turn, cut into
lines. The observation of a line is its speaker marker (the role column at the first
line of a row, or a leading "Name:" in the text), and line features: whether it ends as
a question, and its length or, where it opens a row, the length of the row. States
are the roles. Transitions between rows and the feature probabilities are counted over
all rows with a known role, marked by the column or in the text, on top of a prior: a
conversation opens with system or user, user and assistant take turns, a tool is
called by the assistant and answers it, if any is marked at all. Where some roles are not known, all rows are then
decoded and counted anew, ROUNDS times (Viterbi training). A marker is right with
probability MARKER_TRUST; inside a row the speaker stays unless a marker speaks against
it. Viterbi finds the likeliest roles, and each run of lines with one role in a row is
rendered as one turn.

A conversation of any size is spread over the range partitions of (conversation,
turn, row hash). Each partition sums up the part of a conversation that reaches
over its border as a max-plus matrix of roles; the borders are solved from these few
matrices, and every partition then decodes its part between known roles.

Null texts are one empty line; null or unknown roles are no marker; null turns come
first; null conversation ids are one conversation. Repeated rows and ties of a turn
follow the hash of their content and are all kept; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.frames import store, text_of

ROLES = ("system", "user", "assistant", "tool")
# Names of speakers in transcripts.
SPEAKERS = {
    "system": ("system", "developer", "instructions"),
    "user": ("user", "human", "prompter", "customer", "question", "q", "me"),
    "assistant": ("assistant", "bot", "ai", "gpt", "chatgpt", "model", "agent", "answer", "a"),
    "tool": ("tool", "function", "observation", "ipython"),
}
OF_NAME = {name: i for i, role in enumerate(ROLES) for name in SPEAKERS[role]}
MARKER = re.compile(r"\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?\s*([A-Za-z]{1,12})\s*(?:\*\*)?\s*(?:[:>\]]|\|>)\s*(?:\*\*)?\s*")
MARKER_TRUST = 0.97
STAY = 0.999
SMOOTH = 0.5
# Line lengths and row lengths are told apart by powers of two.
LINE_SIZES, ROW_SIZES = 4, 8
FEATURES = 2 * (LINE_SIZES + ROW_SIZES)
S = len(ROLES)
# What is taken for granted before anything is counted, as a number of conversations.
PRIOR = 8.0
PRIOR_STARTS = np.array([0.25, 0.75, 0.0, 0.0])
PRIOR_MOVES = np.array([[0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0, 0.9, 0.0, 0.1], [0.0, 0.0, 1.0, 0.0]])
# The same for line features: questions, and answers longer than what is asked or set.
PRIOR_FEATURES = np.zeros((S, FEATURES))
PRIOR_FEATURES[1, LINE_SIZES : 2 * LINE_SIZES] = PRIOR_FEATURES[1, -ROW_SIZES:] = 0.06
PRIOR_FEATURES[2, 2 * LINE_SIZES + ROW_SIZES - 2 : 2 * LINE_SIZES + ROW_SIZES] = 0.5
# Log-probability of a role that is taken not to occur.
ABSENT = -30.0
# Times that rows are decoded and counted anew where roles are hidden.
ROUNDS = 4


def role_code(name: str | None) -> int:
    return OF_NAME.get((name or "").strip().lower(), -1)


def observe(role: str | None, text: str) -> tuple[list[str], list[int], list[int]]:
    """Lines of a row without their markers, the marked role of each (or -1), and its feature."""
    lines, marks, kinds = text.split("\n"), [], []
    for i, line in enumerate(lines):
        mark = role_code(role) if i == 0 else -1
        found = MARKER.match(line)
        spoken = role_code(found[1]) if found else -1
        # One letter is a speaker only where the row names none.
        if spoken >= 0 and (len(found[1]) > 1 or mark < 0 and line[found.end() - 1 : found.end()].isspace()):
            mark, lines[i] = (spoken, line[found.end() :]) if mark < 0 else (mark, line)
        marks.append(mark)
        asks = line.rstrip().endswith("?")
        if i:
            kinds.append(asks * LINE_SIZES + min(LINE_SIZES - 1, len(line).bit_length() // 3))
        else:
            kinds.append(2 * LINE_SIZES + asks * ROW_SIZES + min(ROW_SIZES - 1, max(0, len(text).bit_length() - 4)))
    return lines, marks, kinds


def carried(marks: list[int]) -> list[int]:
    """The speaker of every line as far as markers tell: that of the last one."""
    out, speaker = [], -1
    for mark in marks:
        speaker = mark if mark >= 0 else speaker
        out.append(speaker)
    return out


def sorted_rows(talks: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows numbered within their partition of the global order, with the role before them there."""
    body = text_of(talks, text)
    source = talks.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), body.alias("body")
    )
    types = {c: source.schema[c].dataType.simpleString() for c in ("conv", "turn")}
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.xxhash64("role", "body"), F.col("number")]
    numbered = source.withColumn("number", F.monotonically_increasing_id())
    placed = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, at, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = len(batch)
            convs, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            before, codes, leaves, features, speakers, turns = [], [], [], [], [], []
            for c, name, body in zip(convs, roles, batch.column(3).to_pylist(), strict=True):
                _, marks, kinds = observe(name, body)
                same = last is not None and last[0] == c
                before.append(last[1] if same else (None if last is not None else -2))
                spoken = carried(marks)
                codes.append(spoken[0])
                leaves.append(spoken[-1])
                last = (c, leaves[-1])
                features.append(kinds)
                speakers.append(spoken)
                turns.append([a * S + b for a, b, mark in zip(spoken, spoken[1:], marks[1:]) if a >= 0 and mark >= 0])  # noqa: B905
            columns = [
                pa.array(np.full(n, seg), pa.int32()),
                pa.array(np.arange(at, at + n), pa.int64()),
                *(batch.column(i) for i in range(4)),
                pa.array(codes, pa.int32()),
                pa.array(leaves, pa.int32()),
                pa.array(before, pa.int32()),
                *(pa.array(x, pa.list_(pa.int32())) for x in (features, speakers, turns)),
            ]
            at += n
            yield pa.RecordBatch.from_arrays(columns, ["seg", "idx", "conv", "turn", "role", "body", "code", "leave", "before", "kinds", "spoken", "turns"])

    shape = f"seg int, idx long, conv {types['conv']}, turn {types['turn']}, role string, body string, code int, leave int, before int, kinds array<int>, spoken array<int>, turns array<int>"
    return store(placed.mapInArrow(run, shape), "turns")


class Model:
    """Log-probabilities of starts, changes between rows, and line features."""

    def __init__(self, pairs: np.ndarray, starts: np.ndarray, features: np.ndarray, tools: bool = True):
        share = lambda counts: np.log((counts + SMOOTH) / (counts + SMOOTH).sum(-1, keepdims=True))
        self.start = share(starts + PRIOR * PRIOR_STARTS)
        self.move = share(pairs + PRIOR * PRIOR_MOVES)
        self.feature = share(features + PRIOR * PRIOR_FEATURES)
        self.tools = tools
        if not tools:
            # To the model a tool is a user that answers: none speaks where none is named.
            self.start[3] = self.move[:, 3] = ABSENT
        self.inside = np.log(np.full((S, S), (1 - STAY) / (S - 1)) + np.eye(S) * (STAY - (1 - STAY) / (S - 1)))
        self.wrong = np.log((1 - MARKER_TRUST) / (S - 1))
        self.right = np.log(MARKER_TRUST)

    def steps(self, marks: list[int], kinds: list[int], first: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every line of a row the change into it and its emission."""
        out = []
        for i, (mark, kind) in enumerate(zip(marks, kinds, strict=True)):
            emitted = self.feature[:, kind].copy()
            if mark >= 0:
                emitted += self.wrong
                emitted[mark] += self.right - self.wrong
            change = (np.tile(self.start, (S, 1)) if first else self.move) if i == 0 else (self.inside if mark < 0 else self.move)
            out.append((change, emitted))
        return out


def summary(steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Best score from any role before the lines to any role of their last one."""
    total = None
    for change, emitted in steps:
        one = change + emitted[None, :]
        total = one if total is None else (total[:, :, None] + one[None, :, :]).max(1)
    return total


def decode(steps: list[tuple[np.ndarray, np.ndarray]], entry: int | None, leave: int | None) -> list[int]:
    """Likeliest roles of the lines, given the role before them and that of the last one."""
    score, back = None, []
    for change, emitted in steps:
        if score is None:
            reached = change[0 if entry is None else entry]
            back.append(np.full(S, -1))
            score = reached + emitted
            continue
        table = score[:, None] + change
        best = table.argmax(0)
        back.append(best)
        score = table[best, np.arange(S)] + emitted
    role = int(score.argmax()) if leave is None else leave
    path = [role]
    for best in reversed(back[1:]):
        role = int(best[role])
        path.append(role)
    return path[::-1]


def fit(rows: DataFrame) -> Model:
    """Counts over all rows with known roles. Pairs across partition borders come from the border rows."""
    pairs, starts, features = np.zeros((S, S)), np.zeros(S), np.zeros((S, FEATURES))
    for r in rows.where("code >= 0").groupBy("before", "code").agg(F.count("*").alias("n")).collect():
        if r.before is None:
            starts[r.code] += r.n
        elif r.before >= 0:
            pairs[r.before, r.code] += r.n
    for r in rows.select(F.explode("turns").alias("turn")).groupBy("turn").agg(F.count("*").alias("n")).collect():
        pairs[divmod(r.turn, S)] += r.n
    lines = rows.select(F.inline(F.arrays_zip("spoken", "kinds"))).where("spoken >= 0")
    for r in lines.groupBy("spoken", "kinds").agg(F.count("*").alias("n")).collect():
        features[r.spoken, r.kinds] += r.n
    for one, two in borders(rows):
        if two.code >= 0 and one is not None and one.conv == two.conv:
            if one.leave >= 0:
                pairs[one.leave, two.code] += 1
        elif two.code >= 0:
            starts[two.code] += 1
    return Model(pairs, starts, features, bool(features[3].any()))


def borders(rows: DataFrame) -> list:
    """Last row of each partition with the first of the next: two small rows per partition."""
    slim = F.struct("idx", "conv", "code", "leave")
    ends = rows.groupBy("seg").agg(F.min(slim).alias("head"), F.max(slim).alias("tail")).orderBy("seg").collect()
    return [(a.tail if a else None, b.head) for a, b in zip([None, *ends], ends)]  # noqa: B905


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, list[dict]]]:
    """(partition, whether it is the first run there, rows) of every conversation in every partition."""
    held: list[dict] = []
    first = True
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["seg"] != held[0]["seg"] or row["conv"] != held[0]["conv"]):
                yield held[0]["seg"], first, held
                first = row["seg"] != held[0]["seg"]
                held = []
            held.append(row)
    if held:
        yield held[0]["seg"], first, held


def run_steps(model: Model, rows: list[dict], opens: bool) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[list[str]], list[list[int]]]:
    steps, lines, marks = [], [], []
    for k, row in enumerate(rows):
        text, marked, kinds = observe(row["role"], row["body"])
        steps += model.steps(marked, kinds, opens and k == 0)
        lines.append(text)
        marks.append(marked)
    return steps, lines, marks


def render(role: str, text: str) -> str:
    return f"<|im_start|>{role}\n{text}<|im_end|>"


class Talks:
    """The sorted rows of all conversations, and what meets at the borders of their partitions."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        around = borders(rows)
        self.ends = {r.seg: r.n for r in rows.groupBy("seg").agg(F.max("idx").alias("n")).collect()}
        self.segs = sorted(self.ends)
        self.joined = {seg: one is not None and one.conv == two.conv for seg, (one, two) in zip(self.segs, around, strict=True)}
        columns = rows.select("seg", "idx", "conv", "turn", "role", "body")
        self.slices = columns.repartition("seg").sortWithinPartitions("seg", "idx")

    def solved(self, model: Model) -> tuple[dict[int, int], dict[tuple[int, bool], int]]:
        """Roles at the borders, from one matrix for each run that reaches over one."""
        joined = self.joined

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Runs that reach over a border: the first of a partition that goes on, and the last one.
            out: list[tuple[int, bool, bytes]] = []
            tail: tuple[int, bool, list[dict]] | None = None
            for found in runs(batches):
                if tail and tail[0] != found[0]:
                    out += edge(tail, False)
                if found[1]:
                    out += edge(found, True)
                tail = found
            if tail:
                out += edge(tail, False)
            cells = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.bool_(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(cells, ["seg", "head", "matrix"])

        def edge(found: tuple[int, bool, list[dict]], head: bool) -> list[tuple[int, bool, bytes]]:
            seg, first, members = found
            if not head and first:
                return []
            steps, _, _ = run_steps(model, members, not (head and joined[seg]))
            return [(seg, head, summary(steps).tobytes())]

        found = self.slices.mapInArrow(sums, "seg int, head boolean, matrix binary").collect()
        return solve(self.segs, joined, {(r.seg, r["head"]): np.frombuffer(bytes(r.matrix)).reshape(S, S) for r in found})

    def decoder(self, model: Model):
        """Decodes the rows of a partition: (row, lines, marks, roles, role before it or None) of each."""
        entry, leave = self.solved(model)
        joined, ends = self.joined, self.ends

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str], list[int], list[int], int | None]]:
            for seg, first, members in runs(batches):
                goes_on = first and joined[seg]
                steps, lines, marks = run_steps(model, members, not goes_on)
                last = leave.get((seg, first)) if members[-1]["idx"] == ends[seg] else None
                before = entry.get(seg) if goes_on else None
                roles, at = decode(steps, before, last), 0
                for row, text, marked in zip(members, lines, marks, strict=True):
                    mine = roles[at : at + len(text)]
                    at += len(text)
                    yield row, text, marked, mine, before
                    before = mine[-1]

        return rows

    def recounted(self, model: Model) -> Model:
        """A model from the roles that `model` gives to all rows; a task returns one row of counts."""
        decoded = self.decoder(model)

        def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, starts, features = np.zeros((S, S)), np.zeros(S), np.zeros((S, FEATURES))
            for row, _, _, roles, before in decoded(batches):
                if before is None:
                    starts[roles[0]] += 1
                else:
                    pairs[before, roles[0]] += 1
                for role, kind in zip(roles, observe(row["role"], row["body"])[2], strict=True):
                    features[role, kind] += 1
            counts = np.concatenate([pairs.ravel(), starts, features.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()], pa.list_(pa.float64()))], ["counts"])

        total = np.sum([r.counts for r in self.slices.mapInArrow(tally, "counts array<double>").collect()], axis=0)
        pairs, starts, features = np.split(total, [S * S, S * S + S])
        return Model(pairs.reshape(S, S), starts, features.reshape(S, FEATURES), model.tools)


def learned(talks: Talks, rounds: int = ROUNDS) -> Model:
    """The model of all rows: counted where roles are known, by Viterbi training where some are not."""
    model = fit(talks.rows)
    if talks.rows.where(F.exists("spoken", lambda x: x < 0)).isEmpty():
        return model
    for _ in range(rounds):
        model = talks.recounted(model)
    return model


def format_turns(talks: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, part, role, n_lines, rendered): the recovered turns of every row, in order of `part`."""
    held = Talks(sorted_rows(talks, conv, turn, role, text))
    if not held.segs:
        decoded_rows = lambda batches: iter(())
    else:
        decoded_rows = held.decoder(learned(held))
    rows = held.rows

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row, text, marked, mine, _ in decoded_rows(batches):
            cuts = [0, *(i for i in range(1, len(text)) if mine[i] != mine[i - 1] or marked[i] >= 0), len(text)]
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                name = ROLES[mine[a]]
                out.append((row["conv"], row["turn"], part, name, b - a, render(name, "\n".join(text[a:b]))))
            if len(out) >= 2000:
                yield table(out)
                out = []
        yield table(out)

    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    arrow = [_arrow(rows, c) for c in ("conv", "turn")]

    def table(out: list[tuple]) -> pa.RecordBatch:
        types = [*arrow, pa.int32(), pa.string(), pa.int32(), pa.string()]
        cells = [pa.array([o[k] for o in out], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(cells, ["conv", "turn", "part", "role", "n_lines", "rendered"])

    result = held.slices.mapInArrow(decoded, f"conv {kinds[0]}, turn {kinds[1]}, part int, role string, n_lines int, rendered string")
    return result.withColumnsRenamed({"conv": conv, "turn": turn})


def _arrow(rows: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


def solve(segs: list[int], joined: dict[int, bool], matrices: dict) -> tuple[dict[int, int], dict[tuple[int, bool], int]]:
    """Roles at the borders of partitions whose conversation goes on.

    `entry` is the role before a partition's first row, `leave` the role of the last
    row of its first (True) or a later (False) run.
    """
    entry: dict[int, int] = {}
    leave: dict[tuple[int, bool], int] = {}
    chain: list[tuple[int, bool]] = []

    def close() -> None:
        if len(chain) > 1:
            score = matrices[chain[0]][0]
            back = []
            for piece in chain[1:]:
                table = score[:, None] + matrices[piece]
                back.append(table.argmax(0))
                score = table.max(0)
            role = int(score.argmax())
            roles = [role]
            for best in reversed(back):
                role = int(best[role])
                roles.append(role)
            roles.reverse()
            for k, piece in enumerate(chain):
                leave[piece] = roles[k]
                if k:
                    entry[piece[0]] = roles[k - 1]
        chain.clear()

    for seg in segs:
        if not joined[seg]:
            close()
        chain.append((seg, True))
        if (seg, False) in matrices:
            # Another conversation ends the partition: the first run ends the chain.
            close()
            chain.append((seg, False))
    close()
    return entry, leave
