"""Short codes for vectors: a codebook per part, learned over metric trees of the parts.

Components become integers, ``floor(scale * x)``. A vector is cut into ``parts`` equal
stretches. The codebook of a part position starts with that part of the vectors with the
smallest ids. Each round assigns every part to the nearest entry and moves every entry to the
mean of its parts, rounded down; entries without parts stay. All arithmetic that decides is
on integers, so the result does not depend on how the rows are dealt to tasks.

1. Vectors are packed into blocks. In each block every part position gets a metric tree by the
   anchors hierarchy: about as many anchors as the root of the points are placed one after the
   other, each at the point that is farthest from its own anchor, and take over the points that
   are nearer to them (points nearer to their anchor than half the way to the new one are not
   looked at). From this middle layer balls are merged upwards, always the two with the
   smallest common ball, and anchors with many points are divided further downwards in the same
   way. Every ball keeps the sum and the count of its points. Trees are written once.
2. In a round each task walks down its trees, a layer of balls at a time. A ball inherits the
   list of entries that can be nearest to its points and strikes off those that a better entry
   beats on the whole ball: its centre is farther from the halfway plane than its radius. A
   ball with one entry left is wholly owned, and its cached sum and count are added without
   looking at its points. Only points of the smallest balls are compared, with what is left of
   the list.
3. A task returns one sum per entry and component. These are added up by Spark; the driver sees
   the codebooks, ``parts * entries`` rows, and no more.

Ties go to the entry with the lower index; entries equal to an earlier one are never used.
Vectors that are null or hold null or non-finite components take no part. A shorter vector is
filled up with zeros, to a width that ``parts`` divides. Repeated rows, equal ids and null ids
are rows like others; a null id sorts last, equal ids sort by their vectors. With fewer vectors
than ``entries`` the codebook is as short. Integers beyond plus or minus the root of 2^58 / width
count as that bound (2^26 for 64 components), so that no distance leaves 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch

#: Vectors of a block.
BLOCK = 8192
#: Points of a ball that is not divided.
LEAF = 96

_TREE = "struct<order: binary, points: binary, start: binary, end: binary, low: binary, high: binary, radius: binary, sums: binary>"


def usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))


def limit_of(width: int) -> int:
    return math.isqrt((1 << 58) // max(1, width))


def integers(vectors: pa.Array, width: int, scale: float) -> np.ndarray:
    """A list column as rows of ``width`` integers."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -limit_of(width), limit_of(width))
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


# -- trees -------------------------------------------------------------------


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def anchors(points: np.ndarray, count: int) -> list[np.ndarray]:
    """Members of up to ``count`` anchors, none of them empty. The point that is farthest from
    its own anchor is the next one."""
    away, owner = _far(points, points[0]), np.zeros(len(points), np.int64)
    places = [points[0]]
    while len(places) < count:
        place = points[int(away.argmax())]
        half = _far(np.array(places), place) / 2
        look = np.flatnonzero(away > half[owner])  # others are nearer to their own anchor
        near = _far(points[look], place)
        won = near < away[look]
        if not won.any():  # all points are on anchors
            break
        owner[look[won]], away[look[won]] = len(places), near[won]
        places.append(place)
    order = np.argsort(owner, kind="stable")
    groups = np.split(order, np.cumsum(np.bincount(owner, minlength=len(places)))[:-1])
    return [g for g in groups if len(g)]


class Tree:
    """Balls over the points of one part. ``order`` lists the points so that every ball is the
    stretch ``start .. end`` of it; ``low`` and ``high`` are its halves, -1 at the bottom."""

    FIELDS = (("start", np.int32), ("end", np.int32), ("low", np.int32), ("high", np.int32), ("radius", np.float64), ("sums", np.int64))

    def __init__(self, **fields):
        self.__dict__.update(fields)

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> Tree:
        floats = points.astype(np.float64)
        order, kids, spans = [], [], []

        def ball(low: int, high: int, start: int, end: int) -> int:
            kids.append((low, high))
            spans.append((start, end))
            return len(kids) - 1

        def grow(own: np.ndarray) -> int:
            parts = anchors(floats[own], max(2, math.isqrt(len(own)))) if len(own) > leaf else []
            if len(parts) < 2:
                start = len(order)
                order.extend(own.tolist())
                return ball(-1, -1, start, len(order))
            return join([own[p] for p in parts])

        def join(groups: list[np.ndarray]) -> int:
            """Merge balls two by two, the smallest common ball first, then number them."""
            n = len(groups)
            centre = np.array([floats[g].mean(axis=0) for g in groups])
            radius = np.array([_far(floats[g], c).max() for g, c in zip(groups, centre)])
            size = np.array([len(g) for g in groups], float)
            made: list = list(groups)
            common = np.array([_far(centre, c) for c in centre]) + radius[:, None] + radius[None, :]
            np.fill_diagonal(common, np.inf)
            for _ in range(n - 1):
                i, j = divmod(int(common.argmin()), n)
                c = (centre[i] * size[i] + centre[j] * size[j]) / (size[i] + size[j])
                pair = np.sqrt(((centre[[i, j]] - c) ** 2).sum(axis=1))
                radius[i] = max(pair[0] + radius[i], pair[1] + radius[j])
                centre[i], size[i], made[i] = c, size[i] + size[j], (made[i], made[j])
                live = np.isfinite(common[i])
                live[[i, j]] = False
                common[j], common[:, j] = np.inf, np.inf
                common[i] = np.where(live, _far(centre, c) + radius + radius[i], np.inf)
                common[:, i] = common[i]
            top = made[i]
            # Numbered without recursion: the merged layer can be one long chain.
            stack, done = [(top, False)], []
            while stack:
                node, seen = stack.pop()
                if not isinstance(node, tuple):
                    done.append(grow(node))
                elif not seen:
                    stack += [(node, True), (node[1], False), (node[0], False)]
                else:
                    high, low = done.pop(), done.pop()
                    done.append(ball(low, high, spans[low][0], spans[high][1]))
            return done[0]

        grow(np.arange(len(points)))
        placed = np.array(order, np.int32)
        inside = points[placed]
        upto = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(inside, axis=0)))
        start, end = np.array(spans, np.int32).T
        sums = upto[end] - upto[start]
        centre = sums / (end - start)[:, None]
        radius = np.array([_far(inside[a:b], c).max() for a, b, c in zip(start, end, centre)])
        low, high = np.array(kids, np.int32).T
        return cls(order=placed, points=inside, start=start, end=end, low=low, high=high, radius=radius, sums=sums)

    def packed(self) -> dict[str, bytes]:
        small = np.int16 if np.abs(self.points).max(initial=0) < 1 << 15 else np.int32
        body = {"order": self.order.tobytes(), "points": self.points.astype(small).tobytes()}
        return body | {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.FIELDS}

    @classmethod
    def unpacked(cls, body: dict[str, bytes], width: int) -> Tree:
        made = {name: np.frombuffer(body[name], kind) for name, kind in cls.FIELDS}
        made["sums"] = made["sums"].reshape(-1, width)
        order = np.frombuffer(body["order"], np.int32)
        small = np.int16 if len(body["points"]) == 2 * width * len(order) else np.int32
        points = np.frombuffer(body["points"], small).astype(np.int64).reshape(-1, width)
        return cls(order=order, points=points, **made)

    def assign(self, book: np.ndarray, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Sums and counts per entry of ``book`` and the number of points that were compared;
        ``labels``, when given, gets the entry of each point in the order of ``points``."""
        m = len(book)
        entries = book.astype(np.float64)
        apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
        sums, counts, compared = np.zeros_like(book), np.zeros(m, np.int64), 0
        _, first = np.unique(book, axis=0, return_index=True)
        listed = np.zeros((1, m), bool)
        listed[0, first] = True
        balls = np.array([len(self.start) - 1])
        while len(balls):
            centre = self.sums[balls] / (self.end[balls] - self.start[balls])[:, None]
            square = ((centre[:, None] - entries[None]) ** 2).sum(axis=2)
            best = np.where(listed, square, np.inf).argmin(axis=1)
            nearest = np.take_along_axis(square, best[:, None], 1)
            needed = 2 * apart[best] * self.radius[balls, None]
            slack = 1e-9 * (1 + square + nearest + needed)
            listed = listed & ~(square - nearest > needed + slack)
            owned = listed.sum(axis=1) == 1
            np.add.at(sums, best[owned], self.sums[balls[owned]])
            np.add.at(counts, best[owned], (self.end - self.start)[balls[owned]])
            if labels is not None:
                for b, e in zip(balls[owned].tolist(), best[owned].tolist()):
                    labels[self.start[b] : self.end[b]] = e
            bottom = ~owned & (self.low[balls] < 0)
            if bottom.any():
                at = balls[bottom]
                sizes = (self.end - self.start)[at]
                own = np.repeat(self.start[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
                near = nearest_entry(self.points[own], book, np.repeat(listed[bottom], sizes, axis=0))
                np.add.at(sums, near, self.points[own])
                counts += np.bincount(near, minlength=m)
                compared += len(own)
                if labels is not None:
                    labels[own] = near
            rest = ~owned & ~bottom
            balls = np.concatenate((self.low[balls[rest]], self.high[balls[rest]]))
            listed = np.concatenate((listed[rest], listed[rest]))
        return sums, counts, compared


def nearest_entry(points: np.ndarray, book: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """The nearest of the listed entries of each point, ties to the lower index."""
    most = float(max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)))
    kind = np.float64 if 8 * points.shape[1] * most**2 < 2.0**53 else np.int64
    a, b = points.astype(kind), book.astype(kind)
    far = (b**2).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.where(listed, far, np.inf if kind is np.float64 else np.iinfo(np.int64).max).argmin(axis=1)


# -- tables ------------------------------------------------------------------


def _trees(rows: DataFrame, width: int, parts: int, scale: float) -> DataFrame:
    """Blocks of rows: what is carried along, and a tree per part."""
    step = width // parts
    tree = pa.struct([("order", pa.binary()), ("points", pa.binary()), *[(n, pa.binary()) for n, _ in Tree.FIELDS]])

    def pack(carried: list[pa.Array], vectors: list[pa.Array]) -> pa.RecordBatch:
        held, x = pa.concat_arrays(carried), integers(pa.concat_arrays(vectors), width, scale)
        made = [Tree.build(x[:, p * step : (p + 1) * step]).packed() for p in range(parts)]
        every = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
        return pa.RecordBatch.from_arrays([every, pa.array([made], pa.list_(tree))], names=["carried", "trees"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, vectors, n = [], [], 0
        for batch in frames:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK - n)
                carried.append(piece.column("carried"))
                vectors.append(piece.column("v"))
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == BLOCK:
                    yield pack(carried, vectors)
                    carried, vectors, n = [], [], 0
        if n:
            yield pack(carried, vectors)

    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(run, f"carried array<{kind}>, trees array<{_TREE}>")


def _moved(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round."""
    spark, step = blocks.sparkSession, books[0].shape[1]
    sent = spark.sparkContext.broadcast(books)
    shape = (len(books), len(books[0]), step)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in frames:
            for i in range(batch.num_rows):
                for p, body in enumerate(batch.column("trees")[i].as_py()):
                    s, n, _ = Tree.unpacked(body, step).assign(sent.value[p])
                    sums[p] += s
                    counts[p] += n
        part, entry = np.divmod(np.arange(shape[0] * shape[1]), shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(counts.ravel()), pa.array(sums.reshape(-1, step).tolist(), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    partial = blocks.select("trees").mapInArrow(run, "part long, entry long, n long, sums array<long>").where("n > 0")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(step)]
    moved = [book.copy() for book in books]
    for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
        moved[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(step)]
    sent.unpersist()
    return moved


def _coded(blocks: DataFrame, books: list[np.ndarray], schema: str, names: Sequence[str]) -> DataFrame:
    """Carried columns with code and error."""
    spark, step = blocks.sparkSession, books[0].shape[1]
    sent = spark.sparkContext.broadcast(books)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for i in range(batch.num_rows):
                held = batch.column("carried").slice(i, 1).flatten()
                codes = np.zeros((len(held), len(sent.value)), np.uint8)
                error = np.zeros(len(held), np.int64)
                for p, body in enumerate(batch.column("trees")[i].as_py()):
                    tree, book = Tree.unpacked(body, step), sent.value[p]
                    labels = np.zeros(len(held), np.int64)
                    tree.assign(book, labels)
                    codes[tree.order, p] = labels
                    error[tree.order] += ((tree.points - book[labels]) ** 2).sum(axis=1)
                columns = [held.field(k) for k in range(len(names))]
                hexed = [c.tobytes().hex() for c in codes]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(hexed, pa.string()), pa.array(error)], names=[*names, "code", "error"])

    return blocks.mapInArrow(run, schema)


class Compressed:
    """``rows``: the carried columns with ``code`` (two hex digits a part) and ``error``;
    ``codebooks``: one array of integers ``(entry, component)`` per part."""

    def __init__(self, rows: DataFrame, codebooks: list[np.ndarray]):
        self.rows, self.codebooks = rows, codebooks

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and position, with commas."""
        flat = ",".join(str(x) for book in self.codebooks for x in book.ravel().tolist())
        return hashlib.sha256(flat.encode()).hexdigest()


def compress(
    df: DataFrame,
    spark: SparkSession,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: float = 4096.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    carry: Sequence[str] = (),
) -> Compressed:
    """Codes of all usable vectors, with the columns ``[id_column, *carry]``, which may not be
    called ``code`` or ``error``."""
    if not 1 <= entries <= 256:
        raise ValueError("entries is 1 to 256")
    names = [id_column, *carry]
    if {"code", "error"} & set(names):
        raise ValueError("a carried column is called code or error")
    scratch = Scratch(spark, "vector_codes")
    vector = F.col(vector_column).cast("array<double>")
    rows = df.select(F.struct(*names).alias("carried"), vector.alias("v")).where(usable(F.col("v")))
    widest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    width = -(-widest // parts) * parts
    start = rows.orderBy(F.asc_nulls_last(f"carried.{id_column}"), "v").limit(entries).select("v").toArrow()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*names).schema) + ", code string, error long"
    chosen = start.column("v").combine_chunks()
    if not len(chosen):
        return Compressed(spark.createDataFrame([], schema), [np.zeros((0, width // parts), np.int64)] * parts)
    books = np.split(integers(chosen, width, scale), parts, axis=1)
    blocks = scratch.save(_trees(rows, width, parts, scale), "trees")
    for _ in range(rounds):
        books = _moved(blocks, books)
    coded = scratch.save(_coded(blocks, books, schema, names), "coded")
    scratch.drop("trees")
    return Compressed(coded, books)
