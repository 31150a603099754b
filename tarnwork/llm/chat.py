"""Transcript parsing: roles by a hidden Markov model, then canonical turns.

The hidden states are the roles, the observations are the lines of a transcript, described
by the speaker marker they start with, whether they open a message and a conversation, their
length and that of the message they open, a question mark and the form of the line. A model is counted from transcripts whose
roles are known: role of the first line, role changes at message openings and inside
messages, and each feature per role. Markers carry prior counts besides, so that a transcript
with markers is read by them even if none was seen in learning. Viterbi finds the most likely
roles.

A conversation of any length is spread: messages are sorted over all tasks by conversation and
place and packed into chunks of at most ``CHUNK`` messages. A chunk reports, for each role
before it and each role at its end, the best score of a path through it; these small tables
are combined in order per conversation that has several chunks, which fixes the roles at all
chunk borders, and each chunk is then decoded between its borders. The roles are as likely as
those of one pass over the whole conversation; of equally likely ones either may come out.

A null text is one empty line. Null conversation ids form one conversation, null places come
first; equal places are ordered by text. A conversation repeated row by row is one longer
conversation. With nothing to learn from, the roles are user and assistant with prior counts
only.
"""

from __future__ import annotations

import ast
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch

#: Messages and bytes in a chunk.
CHUNK = 1024
CHUNK_BYTES = 4 << 20
#: Prior counts: of a marker with its own role, of anything else.
TRUST, ALPHA = 10_000.0, 1.0
#: Chance of a role change at a line without a marker, besides what was counted.
CHANGE = 1e-3

#: Words that name a speaker.
MARKERS = {
    "user": ("user", "human", "question", "customer", "prompter", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "model", "a"),
    "system": ("system", "instructions"),
}
_FAMILY = {word: role for role, words in MARKERS.items() for word in words}
_MARKER = re.compile(
    r"^\s*(?:[#*>\-\[(<|]+\s*)?(" + "|".join(sorted(_FAMILY, key=len, reverse=True)) + r")\s*[\])|>*]*\s*[:>]\**\s*", re.I
)
_LIST = re.compile(r"\s*(?:[-*•]|\d+[.)])\s")
_CODE = re.compile(r"\s*(?:```|    |\t)")


def features(line: str, opens: bool, first: bool, size: int) -> tuple:
    """What the model sees of a line; ``size`` is the length of the message it opens."""
    found = _MARKER.match(line)
    form = "list" if _LIST.match(line) else "code" if _CODE.match(line) else "text" if line.strip() else "empty"
    return (
        _FAMILY[found[1].lower()] if found else "none",
        f"{'first' if first else 'opens' if opens else 'inside'}",
        min(12, len(line).bit_length()),
        "?" in line,
        form,
        min(40, int(2 * math.log2(size + 1))) if opens else -1,
    )


def stripped(line: str) -> str:
    return _MARKER.sub("", line, count=1)


_CHUNKS = (
    "chunk string, conv long, turn array<long>, tie array<long>, text array<string>, role array<string>, "
    "first_turn long, first_tie long, at long"
)


def _packed(messages: DataFrame) -> DataFrame:
    """Messages in order, a row per chunk. Chunks of a conversation are ordered by
    ``(first_turn, first_tie, at)``."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, size = TaskContext.get().partitionId(), 0, 0
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            first = held[0]
            columns = {
                "chunk": pa.array([f"{part}-{made}"]), "conv": pa.array([first["conv"]], pa.int64()),
                "turn": pa.array([[r["turn"] for r in held]], pa.list_(pa.int64())),
                "tie": pa.array([[r["tie"] for r in held]], pa.list_(pa.int64())),
                "text": pa.array([[r["text"] for r in held]], pa.list_(pa.string())),
                "role": pa.array([[r["role"] for r in held]], pa.list_(pa.string())),
                "first_turn": pa.array([first["turn"]], pa.int64()), "first_tie": pa.array([first["tie"]], pa.int64()),
                "at": pa.array([(part << 32) + made], pa.int64()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in frames:
            for row in batch.to_pylist():
                if held and (row["conv"] != held[0]["conv"] or len(held) >= CHUNK or size > CHUNK_BYTES):
                    yield close()
                    held, size, made = [], 0, made + 1
                held.append(row)
                size += len(row["text"] or "")
        if held:
            yield close()

    parts = max(1, messages.rdd.getNumPartitions())
    ordered = messages.repartitionByRange(parts, "conv", "turn", "tie").sortWithinPartitions("conv", "turn", "tie")
    return ordered.mapInArrow(run, _CHUNKS)


def _lines(texts: list[str | None], starts: bool) -> Iterator[tuple[int, str, tuple]]:
    """``(message, line, features)``; ``starts``: the chunk begins its conversation."""
    for m, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            yield m, line, features(line, k == 0, starts and m == 0 and k == 0, len(text or ""))


class Model:
    """Log probabilities of a model counted as ``{(kind, ...): count}``."""

    def __init__(self, counts: dict[tuple, float]):
        self.counts = counts
        roles = sorted({k[1] for k in counts if k[0] == "start"} | {k[2] for k in counts if k[0] in ("turn", "line")})
        self.roles = roles or ["assistant", "user"]
        n = len(self.roles)
        get = lambda *k: counts.get(k, 0)
        start = np.array([get("start", r) + ALPHA for r in self.roles])
        turn = np.array([[get("turn", a, b) + ALPHA for b in self.roles] for a in self.roles])
        line = np.array([[get("line", a, b) + ALPHA * (a == b) for b in self.roles] for a in self.roles])
        self.start = np.log(start / start.sum())
        self.turn = np.log(turn / turn.sum(axis=1, keepdims=True))
        # Inside a message roles change at markers and hardly anywhere else.
        self.line = np.log((1 - CHANGE) * line / line.sum(axis=1, keepdims=True) + CHANGE / n)
        self.marked = np.full((n, n), -np.log(n))
        values: list[set] = [{*MARKERS, "none"}, *(set() for _ in range(5))]
        for k in counts:
            if k[0] == "seen":
                values[k[2]].add(k[3])
        self.tables: list[dict] = []
        for f, known in enumerate(values):
            count = {v: np.array([get("seen", r, f, v) + self._prior(f, r, v) for r in self.roles]) for v in known}
            total = sum(count.values()) + ALPHA if count else np.full(n, ALPHA)
            self.tables.append({None: np.log(ALPHA / total)} | {v: np.log(c / total) for v, c in count.items()})

    @staticmethod
    def _prior(feature: int, role: str, value) -> float:
        if feature:
            return ALPHA
        return TRUST if value in (role, "none") else ALPHA / TRUST

    def emission(self, seen: tuple) -> np.ndarray:
        out = np.zeros(len(self.roles))
        for f, v in enumerate(seen):
            out = out + self.tables[f].get(v, self.tables[f][None])
        return out

    def steps(self, texts: list, starts: bool) -> Iterator[tuple[int, str, np.ndarray, np.ndarray | None]]:
        """``(message, line, emission, transition)`` per line; no transition at the start."""
        for m, line, seen in _lines(texts, starts):
            inside = self.line if seen[0] == "none" else self.marked
            move = None if seen[1] == "first" else inside if seen[1] == "inside" else self.turn
            yield m, line, self.emission(seen), move

    def through(self, texts: list, starts: bool) -> np.ndarray:
        """Best scores of paths through a chunk: from the role before (a row each; one row
        if the conversation starts here) to the role at its end."""
        best = None
        for _, _, seen, move in self.steps(texts, starts):
            if move is None:
                best = (self.start + seen)[None, :]
            elif best is None:
                best = move + seen
            else:
                best = (best[:, :, None] + move[None]).max(axis=1) + seen
        return best

    def decode(self, texts: list, starts: bool, before: int | None, last: int | None) -> list[tuple[int, str, str]]:
        """``(message, line, role)`` per line, given the role before the chunk and at its end."""
        score, back, lines = None, [], []
        for m, line, seen, move in self.steps(texts, starts):
            lines.append((m, line))
            if score is None:
                score = (self.start if move is None else move[before]) + seen
                back.append(None)
            else:
                reach = score[:, None] + move
                back.append(reach.argmax(axis=0))
                score = reach.max(axis=0) + seen
        state = int(score.argmax()) if last is None else last
        states = [state]
        for came in reversed(back[1:]):
            state = int(came[state])
            states.append(state)
        return [(m, line, self.roles[s]) for (m, line), s in zip(lines, reversed(states))]


_ORDER = ("first_turn", "first_tie", "at")


def _numbered(chunks: DataFrame) -> DataFrame:
    """Which chunk of its conversation each chunk is, and of how many."""
    own = Window.partitionBy("conv")
    small = chunks.select("chunk", "conv", *_ORDER)
    return small.select(
        "chunk",
        F.row_number().over(own.orderBy(*_ORDER)).alias("number"),
        F.count(F.lit(1)).over(own).alias("of"),
    )


def learn(chunks: DataFrame, numbered: DataFrame, known) -> Model:
    """Count a model from the chunks of conversations for which ``known`` holds, a
    condition on ``conv``. The counts are a few numbers per role."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in frames:
            for row in batch.to_pylist():
                last = None
                for m, _, seen in _lines(row["text"], row["number"] == 1):
                    role = row["role"][m]
                    if role is None:
                        last = None
                        continue
                    for f, v in enumerate(seen):
                        count["seen", role, f, repr(v)] += 1
                    if seen[1] == "first":
                        count["start", role, 0, ""] += 1
                    elif last is not None:
                        count["line" if seen[1] == "inside" else "turn", last, 0, role] += 1
                    last = role
        keys = list(count)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.string()))],
                pa.array([count[k] for k in keys], pa.int64()),
            ],
            names=["kind", "role", "feature", "value", "n"],
        )

    train = chunks.where(known).join(numbered, "chunk")
    counted = train.mapInArrow(run, "kind string, role string, feature int, value string, n long")
    # Role changes between chunks: their borders, in order.
    order = Window.partitionBy("conv").orderBy("number")
    border = train.where("of > 1").select(
        "number", F.element_at("role", -1).alias("last"), F.col("role")[0].alias("value"), "conv"
    )
    border = border.withColumn("role", F.lag("last").over(order)).where("role IS NOT NULL AND value IS NOT NULL")
    between = border.groupBy("role", "value").agg(F.count(F.lit(1)).alias("n"))
    between = between.select(F.lit("turn").alias("kind"), "role", F.lit(0).alias("feature"), "value", "n")
    counts: dict[tuple, float] = {}
    summed = counted.unionByName(between).groupBy("kind", "role", "feature", "value").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        key = {
            "seen": lambda r: ("seen", r["role"], r["feature"], ast.literal_eval(r["value"])),
            "start": lambda r: ("start", r["role"]),
        }.get(r["kind"], lambda r: (r["kind"], r["role"], r["value"]))(r)
        counts[key] = counts.get(key, 0) + r["n"]
    return Model(counts)


def _borders(chunks: DataFrame, numbered: DataFrame, model_counts: dict) -> DataFrame:
    """``(chunk, before, last)`` for the chunks of conversations with several."""
    many = chunks.join(numbered.where("of > 1"), "chunk")

    def through(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(model_counts)
        for batch in frames:
            for row in batch.to_pylist():
                table = model.through(row["text"], row["number"] == 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["conv"]], pa.int64()), pa.array([row["chunk"]]),
                        pa.array([row["number"]], pa.int64()), pa.array([table.ravel().tolist()]),
                    ],
                    names=["conv", "chunk", "number", "table"],
                )

    def combine(part: pa.Table) -> pa.Table:
        n = len(Model(model_counts).roles)
        rows = sorted(part.to_pylist(), key=lambda r: r["number"])
        score, back = None, []
        for row in rows:
            table = np.array(row["table"]).reshape(-1, n)
            if score is None:
                back.append(None)
                score = table[0]
            else:
                reach = score[:, None] + table
                back.append(reach.argmax(axis=0))
                score = reach.max(axis=0)
        last = [int(score.argmax())]
        for came in reversed(back[1:]):
            last.append(int(came[last[-1]]))
        last.reverse()
        return pa.table(
            {
                "chunk": [r["chunk"] for r in rows],
                "before": pa.array([None, *last[:-1]], pa.int32()),
                "last": pa.array(last, pa.int32()),
            }
        )

    tables = many.mapInArrow(through, "conv long, chunk string, number long, table array<double>")
    return tables.groupBy("conv").applyInArrow(combine, "chunk string, before int, last int")


def transcripts(
    df: DataFrame,
    spark: SparkSession,
    known,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    text_column: str = "text",
    role_column: str = "role",
) -> DataFrame:
    """Recovered turns: ``(conv_id, turn, part, role, content, rendered)``. A message has one
    part unless markers inside it change the role. ``known`` is a condition on ``conv`` that
    names the conversations to learn from; roles are an input nowhere else. ``rendered`` is the
    canonical turn ``<|role|>``, the content without markers, ``<|end|>``."""
    scratch = Scratch(spark, "chat")
    messages = df.select(
        F.col(conv_column).cast("long").alias("conv"), F.col(turn_column).cast("long").alias("turn"),
        F.xxhash64(text_column).alias("tie"), F.col(text_column).alias("text"), F.col(role_column).alias("role"),
    )
    chunks = scratch.save(_packed(messages), "chunks")
    numbered = scratch.save(_numbered(chunks), "numbered")
    counts = learn(chunks, numbered, known).counts
    borders = scratch.save(_borders(chunks, numbered, counts), "borders")
    ready = chunks.drop("role").join(numbered.select("chunk", "number"), "chunk").join(borders, "chunk", "left")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts)
        for batch in frames:
            out: list[tuple] = []
            for row in batch.to_pylist():
                turns: list[list] = []
                for m, line, role in model.decode(row["text"], row["number"] == 1, row["before"], row["last"]):
                    if turns and turns[-1][0] == m and turns[-1][2] == role:
                        turns[-1][3].append(stripped(line) if _MARKER.match(line) else line)
                    else:
                        part = turns[-1][1] + 1 if turns and turns[-1][0] == m else 0
                        turns.append([m, part, role, [stripped(line)]])
                for m, part, role, lines in turns:
                    content = "\n".join(lines).strip()
                    out.append((row["conv"], row["turn"][m], part, role, content, f"<|{role}|>\n{content}\n<|end|>\n"))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), kinds)],
                    names=["conv_id", "turn", "part", "role", "content", "rendered"],
                )

    schema = "conv_id long, turn long, part int, role string, content string, rendered string"
    return ready.mapInArrow(run, schema)
