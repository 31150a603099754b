"""Mixes against weights, quotas and orders worked out in plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import mixing


def table(spark, sizes, seed=1):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at, "w " * int(rng.integers(1, 40)), source))
            at += 1
    return rows, spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, source string, epoch int, share string")


def weights_by_hand(tokens, budget, entropy, repeats):
    """Bisect one step at a time."""
    total = sum(tokens.values())

    def at(a):
        r = {s: (t / total) ** a for s, t in tokens.items()}
        z = sum(r.values())
        return {s: x / z for s, x in r.items()}

    def fits(a):
        w = at(a)
        h = -sum(x * math.log(x) for x in w.values())
        ok = entropy is None or h <= entropy * math.log(len(w)) + 1e-12
        return ok and (repeats is None or max(w[s] * budget / tokens[s] for s in w) <= repeats)

    low, high = 0.0, 1.0
    if fits(0.0):
        return 0.0, at(0.0)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high, at(high)


@pytest.mark.parametrize(
    "entropy,repeats,budget", [(0.9, None, None), (None, 2.0, None), (0.8, 4.0, 20_000), (1.0, None, 30_000), (0.9, 3.0, 500)]
)
def test_weights_quotas_and_rows(spark, monkeypatch, entropy, repeats, budget):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rows, docs = table(spark, {"big": 500, "mid": 120, "small": 12, None: 40})
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    budget_ = sum(tokens.values()) if budget is None else budget
    planned = mixing.plan(docs, spark, budget, entropy, repeats, seed=5)
    exponent, weights = weights_by_hand(tokens, budget_, entropy, repeats)
    by = {r["source"]: r for r in planned.collect()}
    for s, w in weights.items():
        assert by[s]["weight"] == pytest.approx(w, rel=1e-6) and by[s]["exponent"] == pytest.approx(exponent, abs=1e-6)
    mixed = mixing.mix(docs, planned)
    assert mixed.columns == ["doc_id", "text", "source", "share", "n_tokens", "epoch", "mix_block", "mix_order"]
    got = mixed.collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    assert all(r["n_tokens"] == size[r["doc_id"]] for r in got)
    for s in weights:
        own = [r for r in got if r["source"] == s]
        used, quota = sum(r["n_tokens"] for r in own), by[s]["quota"]
        assert quota - 40 < used <= quota
        times = Counter(r["doc_id"] for r in own)
        full = quota // tokens[s]
        assert set(times.values()) <= {full, full + 1}
        if full:
            assert len(times) == sum(1 for r in rows if r[2] == s)
        assert len(set((r["doc_id"], r["epoch"]) for r in own)) == len(own)


def test_part_epoch_is_a_prefix_of_the_block_permutation(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rows, docs = table(spark, {"a": 300})
    planned = mixing.plan(docs, spark, 3000, None, None, seed=3)
    p = planned.first()
    taken = {r["doc_id"] for r in mixing.mix(docs, planned).collect()}
    key = F.struct("doc_id", F.xxhash64("text"))
    block = mixing._block(key, F.lit(p["blocks"]))
    ordered = docs.select(
        "doc_id", mixing.tokens_of("text").alias("n"),
        mixing._block_order(3, F.lit(0).cast("long"), F.col("source"), block, F.lit(p["blocks"])).alias("a"),
        mixing._order(3, F.lit(0).cast("long"), key).alias("b"),
    ).collect()
    want, left = set(), 3000
    for r in sorted(ordered, key=lambda r: (r["a"], r["b"])):
        if r["n"] > left:
            break
        left -= r["n"]
        want.add(r["doc_id"])
    assert p["full"] == 0 and taken == want and 0 < len(want) < 300


def test_blocks_are_permuted(spark):
    """Every block has a place of its own, whatever the number of blocks asked for."""
    sizes = spark.range(1, 301).select(F.col("id").alias("asked"), mixing._power_of_two(F.col("id")).alias("blocks"))
    one = lambda n: F.lit(n).cast("long")
    place = mixing._block_order(3, F.col("epoch"), F.lit("a"), F.col("block"), F.col("blocks"))
    rows = sizes.withColumn("epoch", F.explode(F.array(one(0), one(1)))).withColumn("block", F.explode(F.sequence(one(0), F.col("blocks") - 1)))
    by = {}
    for r in rows.select("asked", "blocks", "epoch", "block", place.alias("at")).collect():
        by.setdefault((r["asked"], r["blocks"], r["epoch"]), []).append(r["at"])
    assert len(by) == 600
    orders = set()
    for (asked, blocks, _), places in by.items():
        assert blocks == 1 << (asked - 1).bit_length()
        assert sorted(places) == list(range(blocks))
        orders.add(tuple(places))
    assert len(orders) > 10


def test_whole_mix_by_hand(spark, monkeypatch):
    """Blocks of 16 documents. Spark gives the hashes; places, ends and epochs are worked out
    here one document after the other."""
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rows, docs = table(spark, {"big": 700, "mid": 150, "small": 20}, seed=8)
    planned = mixing.plan(docs, spark, 9000, 0.95, 3.0, seed=11)
    plans = {r["source"]: r for r in planned.collect()}
    assert plans["big"]["blocks"] == 64 and plans["mid"]["blocks"] == 16 and plans["small"]["blocks"] == 2
    key, epoch = F.struct("doc_id", F.xxhash64("text")), F.col("e")
    hashed = docs.withColumn("e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")))).select(
        "doc_id", "source", "e", F.xxhash64(key).alias("h"), F.xxhash64(F.lit(12), epoch, key).alias("order"),
        F.xxhash64(F.lit(13), epoch, "source").alias("times"), F.xxhash64(F.lit(14), epoch, "source").alias("shift"),
    ).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    want = Counter()
    for source, p in plans.items():
        total = sum(size[i] for i, _, s in rows if s == source)
        full, left = divmod(p["quota"], total)
        order = []
        for r in hashed:
            if r["source"] == source and r["e"] == full:
                last = p["blocks"] - 1
                place = (((r["times"] & last) | 1) * (r["h"] % p["blocks"]) + (r["shift"] & last)) & last
                order.append((place, r["order"], r["doc_id"]))
        assert len({o[0] for o in order}) > p["blocks"] / 2
        for i, _, s in rows:
            want[i] += full * (s == source)
        for _, _, i in sorted(order):
            if size[i] > left:
                break
            left -= size[i]
            want[i] += 1
    got = Counter(r["doc_id"] for r in mixing.mix(docs, planned).collect())
    assert got == +want


def test_mix_blocks_hold_all_sources_in_proportion(spark):
    _, docs = table(spark, {"a": 4000, "b": 1000})
    mixed = mixing.mix(docs, mixing.plan(docs, spark, entropy=0.95, repeats=None), mix_blocks=8)
    shares = {}
    for r in mixed.groupBy("mix_block", "source").agg(F.sum("n_tokens").alias("n")).collect():
        shares.setdefault(r["mix_block"], {})[r["source"]] = r["n"]
    assert sorted(shares) == list(range(8))
    whole = [x["b"] / (x["a"] + x["b"]) for x in shares.values()]
    assert max(whole) - min(whole) < 0.12


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", "a"), (3, "one two", "a"), (4, None, "empty"), (None, "x y z", None), (5, "lo ng " * 50_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    planned = mixing.plan(docs, spark, entropy=None, repeats=1.0)
    got = [(r["doc_id"], r["epoch"]) for r in mixing.mix(docs, planned).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (3, 0), (3, 0), (None, 0), (5, 0)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs, mixing.plan(docs, spark)).count() == 0
