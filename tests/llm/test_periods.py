"""Periodic runs against a version that tries every period in turn."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tarnwork.llm import periods as P
from tarnwork.llm import queries as Q

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def by_hand(words, least=24, times=3):
    """``(start, length, period)``: stretches of equal words q apart, by every q."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes, out = np.array([numbers[w] for w in words], int), []
    for q in range(1, len(words) // times + 1):
        same = np.concatenate(([0], (codes[:-q] == codes[q:]).astype(int), [0]))
        step = np.diff(same)
        for s, m in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            e = m + q
            whole = e - s >= max(least, times * q)
            if whole and not any((codes[s : e - p] == codes[s + p : e]).all() for p in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def found(words):
    codes = np.array([*map(hash, words), 1 << 61], np.int64)
    _, codes = np.unique(codes, return_inverse=True)
    return [(s, e - s, q) for s, e, q in P.runs_of(codes.astype(np.int64), len(words))]


def texts(rng):
    for n in (0, 1, 23, 24, 25, 200):
        yield ["a"] * n
    a, b = ["x"], ["x", "y"]
    while len(b) < 600:
        a, b = b, b + a
    yield b
    yield [str(bin(i).count("1") % 2) for i in range(600)]
    for _ in range(300):
        n, out = rng.randrange(1, 300), []
        while len(out) < n:
            part = [str(rng.randrange(3)) for _ in range(rng.randrange(1, 30))]
            out += part * rng.randrange(1, 8) + part[: rng.randrange(len(part))]
        yield out


def test_runs_against_every_period():
    for words in texts(random.Random(3)):
        assert found(words) == by_hand(words)


def test_equal_hashes_are_settled_by_words(monkeypatch):
    """Even a hash that is equal for all words gives no wrong run."""
    monkeypatch.setattr(P, "mix64", lambda x: np.ones(len(x), np.uint64))
    words = ["a", "b", "c"] * 12 + [str(i) for i in range(40)]
    assert set(found(words)) <= set(by_hand(words))


def test_range_successor():
    rng = np.random.default_rng(1)
    values = rng.permutation(1000).astype(np.int32)
    tree = P.Wavelets(values)
    low = rng.integers(0, 1000, 500)
    high = np.minimum(1000, low + rng.integers(0, 300, 500))
    least = rng.integers(0, 1100, 500)
    got = tree.successor(low, high, least)
    for a, b, x, y in zip(low, high, least, got):
        some = values[a:b][values[a:b] >= x]
        assert y == (some.min() if len(some) else 1 << 62)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "PACK_BYTES", 500)
    rng = random.Random(9)
    rows = [(1, None, "x"), (1, "", "x"), (None, " \t\n", None), (2, "a b\tc " * 20, ""), (2, "a b\tc " * 20, ""), (3, "w v " * 30, "")]
    rows += [(10 + i, " ".join(t), "") for i, t in zip(range(60), texts(rng))]
    rows += [(99, "one two three " * 20_000 + "end", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = P.periodic(docs).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[1])
    want = []
    for i, text, _ in rows:
        words = words_of(text or "")
        runs = by_hand(words) if i != 99 else [(0, 60_000, 3)]
        left = collapsed_by_hand(words, runs) if i != 99 else ["one", "two", "three", "end"]
        want.append((i, len(words), runs, " ".join(left)))
    assert sorted([(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=key) == sorted(want, key=key)
    assert P.periodic(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        P.periodic(docs, times=2)


def test_query_by_hand(spark, sf_dir):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in Q.op11_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == rows.keys()
    some = 0
    for i, text in rows.items():
        words, h = words_of(text or ""), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = by_hand(words)
        some += bool(runs)
        top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[i]) == (
            i,
            len(runs),
            *top,
            1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(collapsed_by_hand(words, runs))),
        )
    assert some
