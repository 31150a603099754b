"""Removal of repeated passages of ``width`` words, with a count-min prefilter.

Every run of ``width`` words is a window. A word goes when a window that covers it
occurs anywhere else, in the same text or another. Windows are judged on the input.

1. Texts are packed into blocks, words joined by one space, and written as a table
   bucketed by block, so that later passes read the texts without shuffling them.
2. Each block hashes its windows (a rolling hash over all words at once) and sends, per
   slice of the hash space, the counter cells it would raise: a sparse partition sketch.
   A slice's task adds the sketches up to a two-row count-min sketch and answers every
   block with one bit per window: estimated to occur more than once. Estimates are
   never too low, so no repeated window is lost.
3. For the windows with that bit only, blocks send 128-bit digests of the words
   themselves; a slice's task groups equal digests and answers with exact bits.
4. Blocks mark the words that repeated windows cover and cut them out.

A window that occurs very often is sent once per block, and the slices are even parts of
a mixed hash, so common passages do not gather in one task. Slices grow in number with
the windows, blocks with the bytes; no task holds more than one of either. A text
longer than a block is a block of its own: the longest text must fit a worker, at about
40 bytes of memory per word besides the text.

Nulls and texts without words: no words, nothing removed, an empty rest. Rows with equal
ids are separate texts. The result has one row per input row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch, bits_of, mix64, texts_of, vote

#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: Bytes hashed at a time.
PART_BYTES = 1 << 20
#: Windows per slice of the hash space, and cells in each row of its sketch.
SLICE_WINDOWS = 1 << 20
CELLS = 1 << 22

_BYTES = mix64(np.arange(256, dtype=np.uint64)) | np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_CODEC = "zstd"

_VOTES = "block long, slice long, n long, bits binary"
_SENT = "block long, slice long, body binary, twice binary"


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def word_bounds(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text joined by single spaces."""
    if not line:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(line)]))


def word_hashes(
    line: bytes, starts: np.ndarray, ends: np.ndarray, part: int = PART_BYTES
) -> np.ndarray:
    """A 64-bit hash per word, by prefix sums over the bytes, a part at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + part)))
        low, high = int(starts[at]), int(ends[to - 1])
        codes = np.frombuffer(line, np.uint8, high - low, low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[codes] * _powers(_BASE, high - low), out=sums[1:])
        back = _powers(_inverse(_BASE), high - low + 1)
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * back[a]
        at = to
    return mix64(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` entries."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _powers(_STEP, n), out=sums[1:])
    back = _powers(_inverse(_STEP), n - width + 1)
    return mix64((sums[width:] - sums[: n - width + 1]) * back)


class Block:
    """The texts of a block and the starts of their windows."""

    def __init__(self, line: bytes, counts: np.ndarray, width: int):
        self.line, self.width = line, width
        self.starts, self.ends = word_bounds(line)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        inside = np.ones(max(0, len(self.starts) - width + 1), bool)
        for to in self.first[1:-1].tolist():  # windows that would run into the next text
            inside[max(0, to - width + 1) : to] = False
        self.at = np.flatnonzero(inside)

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct window hashes in order, which one each window has, how often each occurs."""
        found = window_hashes(word_hashes(self.line, self.starts, self.ends), self.width)[self.at]
        return np.unique(found, return_inverse=True, return_counts=True)

    def digests(self, at: np.ndarray) -> np.ndarray:
        """128-bit digests of the windows that start at words ``at``, as two columns."""
        digest, line = xxhash.xxh3_128_digest, self.line
        a, b = self.starts[at].tolist(), self.ends[at + self.width - 1].tolist()
        return np.frombuffer(b"".join([digest(line[i:j]) for i, j in zip(a, b)]), np.uint64).reshape(-1, 2)

    def estimated(self, votes: list) -> np.ndarray:
        """Starts of the windows that the merged sketch holds for repeated."""
        if not len(self.at):
            return self.at
        _, which, _ = self.hashes()
        return self.at[_joined(votes)[which]]

    def unique_digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _distinct(self.digests(at))


def _distinct(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of two columns in order, which one each row is, counts."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    ordered = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    number = np.cumsum(new) - 1
    which = np.empty(len(pairs), np.int64)
    which[order] = number
    return ordered[new], which, np.bincount(number, minlength=int(new.sum()))


def _joined(votes: list) -> np.ndarray:
    parts = [bits_of(v["bits"], v["n"]) for v in sorted(votes, key=lambda v: v["slice"])]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _place(h: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """Slice of a hash and its position in the slice, 32 bits; both ascend with it."""
    k = np.uint64(slices)
    low = ((h & np.uint64(0xFFFFFFFF)) * k) >> np.uint64(32)
    scaled = (h >> np.uint64(32)) * k + low
    return (scaled >> np.uint64(32)).astype(np.int64), scaled.astype(np.uint32)


def _pack_cells(cells: np.ndarray) -> bytes:
    steps = np.diff(cells, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4)
    body = np.ascontiguousarray(steps.T).tobytes()
    return len(body).to_bytes(4, "little") + pa.compress(body, codec=_CODEC, asbytes=True)


def _unpack_cells(body: bytes) -> np.ndarray:
    size = int.from_bytes(body[:4], "little")
    raw = pa.decompress(body[4:], decompressed_size=size, codec=_CODEC, asbytes=True)
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T)
    return np.cumsum(steps.view(np.uint32).ravel(), dtype=np.uint32)


def _sent(block: int, place: np.ndarray, many: np.ndarray, pack) -> pa.RecordBatch | None:
    """One row per slice; ``place`` ascends."""
    if not len(place):
        return None
    edge = np.flatnonzero(np.diff(place, prepend=-1))
    bounds = list(zip(edge.tolist(), [*edge[1:].tolist(), len(place)]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * len(bounds), pa.int64()),
            pa.array(place[edge]),
            pa.array([pack(a, b) for a, b in bounds], pa.binary()),
            pa.array([np.packbits(many[a:b], bitorder="little").tobytes() for a, b in bounds], pa.binary()),
        ],
        names=["block", "slice", "body", "twice"],
    )


def _blocks(
    docs: DataFrame, id_column: str, text_column: str, width: int, block_bytes: int
) -> DataFrame:
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, counts, lines, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def close():
            windows = sum(max(0, n - width + 1) for n in counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([made], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([windows], pa.int64()),
                    pa.array([b" ".join(x for x in lines if x)], pa.binary()),
                ],
                names=["block", "ids", "counts", "windows", "line"],
            )

        for batch in frames:
            for i, text in zip(batch.column("id").to_pylist(), texts_of(batch, "text")):
                tokens = (text or b"").split()
                line = b" ".join(tokens)
                if ids and size + len(line) > block_bytes:
                    yield close()
                    made, ids, counts, lines, size = made + 1, [], [], [], 0
                ids.append(i)
                counts.append(len(tokens))
                lines.append(line)
                size += len(line) + 1
        if ids:
            yield close()

    schema = "block long, ids array<long>, counts array<long>, windows long, line binary"
    return picked.mapInArrow(run, schema)


def _by_block(blocks: DataFrame, votes: list[DataFrame]) -> DataFrame:
    """Blocks beside the answers they got; the blocks stay where they are."""
    joined = blocks
    for i, v in enumerate(votes):
        answers = v.groupBy("block").agg(
            F.collect_list(F.struct("slice", "n", "bits")).alias(f"votes{i}")
        )
        joined = joined.join(answers.hint("shuffle_hash"), "block", "left")
    return joined


def _rows(frames: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in frames:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


class Repeats:
    """Repeated passages of one table; ``close`` removes the scratch table."""

    def __init__(
        self,
        spark: SparkSession,
        width: int = 35,
        block_bytes: int = BLOCK_BYTES,
        slice_windows: int = SLICE_WINDOWS,
        cells: int = CELLS,
    ):
        if width < 1:
            raise ValueError("width must be 1 or more")
        self.spark, self.width, self.block_bytes = spark, width, block_bytes
        self.slice_windows, self.cells = slice_windows, cells
        self.scratch = Scratch(spark, "substring")
        self.table = f"repeats_{uuid.uuid4().hex}"

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.scratch.drop("blocks", "estimated", "repeated")

    def removed(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """``(id, n_words, n_removed, spans, kept)`` per row: the removed runs of words
        as ``[from, to)`` and the rest, words joined by one space."""
        width, spark = self.width, self.spark
        buckets = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        (
            _blocks(docs, id_column, text_column, width, self.block_bytes)
            .write.bucketBy(buckets, "block")
            .option("path", self.scratch.path("blocks"))
            .option("compression", "zstd")
            .saveAsTable(self.table)
        )
        blocks = spark.table(self.table)
        windows = blocks.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
        slices = max(1, -(-windows // self.slice_windows))
        estimated = self.scratch.save(self._estimate(blocks, slices), "estimated")
        repeated = self.scratch.save(self._group(blocks, estimated, slices), "repeated")

        def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(frames):
                yield from _cut(row, width)

        both = _by_block(blocks, [estimated, repeated]).drop("windows")
        schema = (
            "id long, n_words long, n_removed long, "
            "spans array<struct<from: long, to: long>>, kept string"
        )
        return both.mapInArrow(cut, schema)

    def _estimate(self, blocks: DataFrame, slices: int) -> DataFrame:
        width, row_cells = self.width, self.cells

        def send(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(frames):
                block = Block(row["line"], np.array(row["counts"]), width)
                if len(block.at):
                    found, _, counts = block.hashes()
                    place, cells = _place(found, slices)
                    yield _sent(row["block"], place, counts > 1, lambda a, b: _pack_cells(cells[a:b]))

        def decide(cells: np.ndarray, twice: np.ndarray) -> np.ndarray:
            """Both rows of the merged sketch; the smaller count of a cell's two counts."""
            least = np.full(len(cells), 2, np.int64)
            for row in range(2):
                at = cells if row == 0 else mix64(cells.astype(np.uint64))
                at = (at % row_cells).astype(np.int64)
                counts = np.bincount(np.concatenate((at, at[twice])), minlength=row_cells)
                least = np.minimum(least, counts[at])
            return least >= 2

        sent = blocks.select("block", "counts", "line").mapInArrow(send, _SENT)
        return sent.groupBy("slice").applyInArrow(lambda t: vote(t, _unpack_cells, decide), _VOTES)

    def _group(self, blocks: DataFrame, estimated: DataFrame, slices: int) -> DataFrame:
        width = self.width

        def send(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(frames):
                block = Block(row["line"], np.array(row["counts"]), width)
                at = block.estimated(row["votes0"] or [])
                if len(at):
                    found, _, counts = block.unique_digests(at)
                    place, _ = _place(found[:, 0], slices)
                    yield _sent(row["block"], place, counts > 1, lambda a, b: found[a:b].tobytes())

        def decide(pairs: np.ndarray, twice: np.ndarray) -> np.ndarray:
            _, which, counts = _distinct(pairs)
            again = np.bincount(which[twice], minlength=len(counts))
            return (counts + again >= 2)[which]

        def read(body: bytes) -> np.ndarray:
            return np.frombuffer(body, np.uint64).reshape(-1, 2)

        both = _by_block(blocks.select("block", "counts", "line"), [estimated])
        sent = both.mapInArrow(send, _SENT)
        return sent.groupBy("slice").applyInArrow(lambda t: vote(t, read, decide), _VOTES)


def _cut(row: dict, width: int) -> Iterator[pa.RecordBatch]:
    block = Block(row["line"], np.array(row["counts"]), width)
    at = block.estimated(row["votes0"] or [])
    if len(at):
        _, which, _ = block.unique_digests(at)
        at = at[_joined(row["votes1"])[which]]
    step = np.zeros(len(block.starts) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    gone = np.cumsum(step[:-1]) > 0
    change = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    runs = change.reshape(-1, 2)
    held: list[tuple] = []
    for k, i in enumerate(row["ids"]):
        low, high = int(block.first[k]), int(block.first[k + 1])
        a, b = np.searchsorted(runs[:, 1], low, "right"), np.searchsorted(runs[:, 0], high)
        spans = np.clip(runs[a:b], low, high)
        edges = np.concatenate(([low], spans.ravel(), [high])).reshape(-1, 2).tolist()
        kept = b" ".join(
            block.line[block.starts[x] : block.ends[y - 1]] for x, y in edges if y > x
        )
        spans = spans - low
        held.append((i, high - low, int((spans[:, 1] - spans[:, 0]).sum()), spans.tolist(), kept))
    ids, words, removed, spans, kept = zip(*held)
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(words, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array([[{"from": x, "to": y} for x, y in s] for s in spans], span),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        names=["id", "n_words", "n_removed", "spans", "kept"],
    )
