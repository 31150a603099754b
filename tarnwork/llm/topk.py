"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments. With each segment's mean and deviation, the inner product
of two vectors is at most the sum over segments of ``length * mean * mean + deviation *
deviation`` (Cauchy-Schwarz on what is left after the means). Coarse segments come first;
pairs whose bound is below the k-th best score known so far are dropped, the others go on
to finer segments, and only survivors are scored exactly. Bounds carry a margin for
rounding, so nothing is lost.

Components are ``floor(scale * x)``, kept as doubles, which hold every such value exactly.
Scores are exact integers: by matrix product where all sums fit 53 bits, with Python's
integers otherwise; a score outside the range of long is clamped to it.

Vectors that are null or hold null or non-finite components take no part. A shorter vector
is filled up with zeros. Every row is a candidate, repeated rows (equal id and vector) as
often as they stand there, but never for a query of its own id; queries that share an id
share one list, repeated ones are asked once. A null id takes no part.

Queries go to the candidates in blocks: a task holds one block of each. The rows that are
shuffled are the query blocks, once per candidate block, and k results per query and
candidate block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch

CANDIDATES = 16384
QUERIES = 1024
#: Pairs looked at together.
PAIRS = 1 << 19
#: Pairs gathered together when few of them are left.
GATHERED = 1 << 15
#: Numbers of segments, coarse to fine.
LEVELS = (2, 8, 32)

_BLOCK = "block long, ids binary, width long, body binary"


def vectors(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """``(id, v, scale)``: usable vectors, which ``_blocks`` scales and floors."""
    v = F.col(vector_column).cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    picked = df.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable)
    return picked.withColumn("scale", F.lit(float(scale)))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Vectors packed into blocks, each numbered by its task and place."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        held: list[list[float]] = []

        def close() -> pa.RecordBatch:
            width = max(map(len, held))
            body = np.zeros((len(held), width))
            for i, v in enumerate(held):
                body[i, : len(v)] = v
            keys = np.array(ids, np.int64).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([keys]), pa.array([width]), pa.array([body.tobytes()])],
                names=["block", "ids", "width", "body"],
            )

        for batch in frames:
            columns = [batch.column(c).to_pylist() for c in ("id", "v", "scale")]
            for key, v, scale in zip(*columns):
                ids.append(key)
                held.append(np.floor(np.array(v) * scale))
                if len(ids) == size:
                    yield close()
                    number, ids, held = number + 1, [], []
        if ids:
            yield close()

    return rows.mapInArrow(run, _BLOCK)


def segments(x: np.ndarray, count: int) -> np.ndarray:
    """Means and deviations of ``count`` segments, scaled so that the product of two rows
    bounds the inner product of the vectors."""
    length = -(-x.shape[1] // count) or 1
    wide = np.zeros((len(x), count * length))
    wide[:, : x.shape[1]] = x
    parts = wide.reshape(len(x), count, length)
    mean = parts.mean(axis=2)
    left = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))
    return np.concatenate((mean * np.sqrt(length), left), axis=1)


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``a[i]`` and ``b[j]``: all at once when many pairs are asked
    for, else gathered in parts."""
    if 10 * len(i) > len(a) * len(b):
        return (a @ b.T)[i, j]
    parts = [slice(k, k + GATHERED) for k in range(0, len(i), GATHERED)]
    return np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", a[i[p]], b[j[p]]) for p in parts]])


def exact_scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``a[i]`` and ``b[j]`` as longs."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2.0**53:  # every partial sum is an integer that a double holds exactly
        return _products(a, b, i, j).astype(np.int64)
    low, high = -(2**63), 2**63 - 1
    rows_a, rows_b = a.tolist(), b.tolist()
    sums = [sum(int(x) * int(y) for x, y in zip(rows_a[p], rows_b[q])) for p, q in zip(i.tolist(), j.tolist())]
    return np.array([min(max(s, low), high) for s in sums], np.int64)


def best_of_block(
    qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, levels: tuple[int, ...] = LEVELS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of query and candidate and the score of the ``k`` best candidates of each
    query, ties to the smaller id."""
    width = max(q.shape[1], c.shape[1])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    c = np.pad(c, ((0, 0), (0, width - c.shape[1])))
    levels = [n for n in levels if n < width] or [1]
    with np.errstate(all="ignore"):
        stats = [(segments(q, n), segments(c, n)) for n in levels]
        norm_q, norm_c = np.sqrt((q**2).sum(1)), np.sqrt((c**2).sum(1))
    out: list[tuple] = []
    for at in range(0, len(q), max(1, PAIRS // len(c))):
        rows = np.arange(at, min(len(q), at + max(1, PAIRS // len(c))))
        with np.errstate(all="ignore"):
            bound = stats[0][0][rows] @ stats[0][1].T
        own = qid[rows, None] == cid[None, :]
        bound[own] = -np.inf
        # A first threshold from the candidates that look best.
        seeds = min(len(c), 4 * k)
        first = np.argpartition(np.nan_to_num(-bound, nan=-np.inf), seeds - 1, axis=1)[:, :seeds]
        i, j = np.repeat(np.arange(len(rows)), seeds), first.ravel()
        known = exact_scores(q[rows], c, i, j).astype(np.float64).reshape(len(rows), seeds)
        known[np.take_along_axis(own, first, 1)] = -np.inf
        least = np.sort(known, axis=1)[:, -k] if seeds >= k else np.full(len(rows), -np.inf)
        with np.errstate(all="ignore"):
            margin = 1 + 1e-9 * norm_q[rows, None] * norm_c[None, :]
            i, j = np.nonzero(~(bound + margin < least[:, None]) & ~own)
        for own_q, own_c in stats[1:]:
            with np.errstate(all="ignore"):
                finer = _products(own_q[rows], own_c, i, j)
                stay = ~(finer + 1 + 1e-9 * norm_q[rows[i]] * norm_c[j] < least[i])
            i, j = i[stay], j[stay]
        score = exact_scores(q[rows], c, i, j)
        order = np.lexsort((cid[j], -score.astype(object) if (score == -(2**63)).any() else -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out.append((rows[i[keep]], j[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(
    df: DataFrame,
    spark: SparkSession,
    is_query: Column,
    k: int = 10,
    scale: float = 1024.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``. ``is_query`` is a condition on column ``id``."""
    scratch = Scratch(spark, "topk")
    usable = vectors(df, id_column, vector_column, scale)
    candidates = scratch.save(_blocks(usable, CANDIDATES), "candidates")
    queries = scratch.save(_blocks(usable.where(is_query).distinct(), QUERIES), "queries")
    # One row per block of queries and block of candidates: the list of block numbers
    # has an entry per 16,384 vectors and is made where it is needed.
    asked = queries.select(F.col("ids").alias("query_ids"), F.col("width").alias("query_width"), F.col("body").alias("query_body"))
    every = candidates.agg(F.collect_list("block").alias("all")).scalar()
    spread = asked.withColumn("block", F.explode(every))
    pairs = spread.repartition(max(1, candidates.count()), "block").join(candidates, "block")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                qid, cid = (np.frombuffer(row[x], np.int64) for x in ("query_ids", "ids"))
                q = np.frombuffer(row["query_body"]).reshape(len(qid), row["query_width"])
                c = np.frombuffer(row["body"]).reshape(len(cid), row["width"])
                i, j, score = best_of_block(qid, q, cid, c, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[i]), pa.array(cid[j]), pa.array(score)], names=["query_id", "vec_id", "score"]
                )

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
