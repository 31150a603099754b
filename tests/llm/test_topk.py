"""Top-k search against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import topk


def by_hand(rows, k, is_query):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in ok]
    out = set()
    for q in {i for i, _ in ok if is_query(i)}:
        scores = [
            (min(max(sum(a * b for a, b in zip(x, y)), -(2**63)), 2**63 - 1), c)
            for i, x in set(ok) if i == q for c, y in ok if c != q
        ]
        for rank, (s, c) in enumerate(sorted(scores, key=lambda t: (-t[0], t[1]))[:k], 1):
            out.add((q, rank, c, s))
    return out


@pytest.mark.parametrize("k", [1, 10])
def test_search_matches_all_scores(spark, k):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(7, 24)).astype(np.float32)
    rows = [(i, (centres[i % 7] + 0.2 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[5]]
    rows += [(600, None), (700, [1.0, None]), (701, [float("nan")] * 24), (800, [float("inf")]), (None, [1.0]), (900, []), (1000, [0.5, -0.25])]
    rows += [(1100, [0.0] * 24), (1200, [-1.0] * 30)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, id int, score int")
    got = topk.search(df.repartition(5), spark, F.col("id") % 100 == 0, k=k).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == by_hand(rows, k, lambda i: i % 100 == 0)


def test_huge_components_stay_exact(spark):
    rows = [(0, [1e12, 3.0]), (1, [1e12, 2.0]), (2, [1e12 + 1 / 1024, 2.0]), (3, [-1e300, 1.0]), (4, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, spark, F.col("id") == 0)
    assert set(map(tuple, got.collect())) == by_hand(rows, 10, lambda i: i == 0)


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(50, 37)) * 900, rng.normal(size=(60, 37)) * 900
    for n in (1, 2, 8, 32, 37):
        assert (topk.segments(a, n) @ topk.segments(b, n).T >= a @ b.T - 1e-6).all()


def test_repeated_rows_are_candidates_of_their_own(spark):
    rows = [(100, [1.0]), (100, [1.0]), (6, [2.0]), (6, [2.0]), (7, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df, spark, F.col("id") % 100 == 0, k=2).collect()
    assert sorted(map(tuple, got)) == [(100, 1, 7, 3 << 20), (100, 2, 6, 2 << 20)]
    got = topk.search(df, spark, F.col("id") % 100 == 0, k=9).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [7, 6, 6]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(df, spark, F.col("id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert topk.search(one, spark, F.col("id") % 100 == 0).count() == 0
