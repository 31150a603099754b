"""Codebooks over metric trees against plain Lloyd rounds on Python integers."""

import random

import numpy as np
import pytest

from tarnwork.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label string, v string, trees int"


def by_hand(rows, parts, entries, rounds, scale):
    """``({(id, vector): (code, error)}, codebooks)``."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in kept), default=1) // parts) * parts
    whole = [(i, v, [int(np.floor(float(x) * scale)) for x in v] + [0] * (width - len(v))) for i, v in kept]
    step = width // parts
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[2][p * step : (p + 1) * step] for r in whole[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, _, x in whole:
                own[nearest(x[p * step : (p + 1) * step], books[p])[1]].append(x[p * step : (p + 1) * step])
            books[p] = [[sum(c) // len(xs) for c in zip(*xs)] if xs else b for xs, b in zip(own, books[p])]
    out = []
    for i, v, x in whole:
        found = [nearest(x[p * step : (p + 1) * step], books[p]) for p in range(parts)]
        out.append((i, tuple(v), "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def vectors(rng, n, width):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    for i in range(n):
        c = rng.choice(centres)
        yield i, [float(np.float32(x + rng.gauss(0, 0.05))) for x in c]


@pytest.mark.parametrize("leaf", [1, 8, 96])
def test_tree_assigns_like_a_full_comparison(leaf):
    rng = np.random.default_rng(leaf)
    for case in range(25):
        n, m = int(rng.integers(1, 400)), int(rng.integers(1, 20))
        spread = 10.0 ** rng.integers(0, 6)
        points = np.floor(rng.normal(0, spread, (n, 3))).astype(np.int64)
        points += (rng.integers(0, 4, (n, 1)) * spread * 10).astype(np.int64)
        if case % 5 == 0:
            points[:] = points[0]
        book = points[rng.integers(0, n, m)]
        tree = V.Tree.unpacked(V.Tree.build(points, leaf).packed(), 3)
        assert sorted(tree.order.tolist()) == list(range(n))
        assert (tree.points == points[tree.order]).all()
        labels = np.zeros(n, np.int64)
        sums, counts, _ = tree.assign(book, labels)
        want = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (labels == want).all()
        assert (counts == np.bincount(want, minlength=m)).all()
        for e in range(m):
            assert (sums[e] == tree.points[want == e].sum(axis=0)).all()


def test_balls_hold_their_points_and_most_are_owned_whole():
    rng = random.Random(4)
    points = np.array([[int(1000 * x) for x in v] for _, v in vectors(rng, 4000, 8)], np.int64)
    tree = V.Tree.build(points)
    for a, b, r, s in zip(tree.start, tree.end, tree.radius, tree.sums):
        own = tree.points[a:b]
        assert (own.sum(axis=0) == s).all()
        assert np.sqrt(((own - s / (b - a)) ** 2).sum(axis=1)).max() <= r + 1e-6
    book = np.array([points[:].mean(axis=0), *points[:5]]).astype(np.int64)
    _, _, compared = tree.assign(book)
    assert compared < len(points)


def rows_of(spark, rows, **options):
    data = [(i, v, "a" if (i or 0) % 3 else None, "", 1) for i, v in rows]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    made = V.compress(df, spark, id_column="vec_id", carry=["label"], **options)
    return made, made.rows.collect()


def test_against_hand_written_rounds(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 100)
    monkeypatch.setattr(V, "LEAF", 4)
    rng = random.Random(2)
    rows = list(vectors(rng, 300, 12))
    rows += [(i, [float(rng.randrange(-1, 2)) for _ in range(12)]) for i in range(300, 400)]
    made, got = rows_of(spark, rows, parts=4, entries=16, rounds=6, scale=64.0)
    want, books = by_hand(rows, 4, 16, 6, 64.0)
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted((i, c, e) for i, _, c, e in want)
    assert [b.tolist() for b in made.codebooks] == books


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None, 1.0]), (3, [nan, 1.0]), (4, [inf]), (5, [0.5, -0.25, 3.0]), (5, [0.5, -0.25, 3.0])]
    rows += [(5, [1.0]), (None, [2.0, 2.0, 2.0, 2.0]), (None, None), (7, []), (8, [0.0] * 4)]
    made, got = rows_of(spark, rows, parts=2, entries=16, rounds=3, scale=10.0)
    want, books = by_hand(rows, 2, 16, 3, 10.0)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r["vec_id"], r["code"], r["error"]) for r in got], key=key) == sorted([(i, c, e) for i, _, c, e in want], key=key)
    assert [b.tolist() for b in made.codebooks] == books
    assert made.rows.columns == ["vec_id", "label", "code", "error"]


def test_empty_table_and_huge_values(spark):
    made, got = rows_of(spark, [], parts=8)
    assert got == [] and len(made.codebooks) == 8
    made, got = rows_of(spark, [(1, [3e38, -3e38]), (2, [0.0, 0.0])], parts=2, entries=1, rounds=1)
    assert all(0 <= r["error"] < 2**63 for r in got)
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, code int"), spark, carry=["code"])
