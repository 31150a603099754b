"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarnwork.llm import simhash
from tarnwork.llm.common import Scratch
from tarnwork.llm.components import connected


def by_hand(text, words=3):
    """Fingerprint of one text, bit by bit."""
    raw = (text or "").encode()
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    for c in b"\t\n\x0b\x0c\r":
        raw = raw.replace(bytes([c]), b" ")
    tokens = [w for w in raw.split(b" ") if w]
    if not tokens:
        return 0
    shingles = [tokens[i : i + words] for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64(b" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, ids, radius=3):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, x in zip(group, ids):
        if x is not None:
            least[g] = min(x, least.get(g, x))
    return [least.get(g) for g in group]


TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from it all day"),
    (2, "THE quick brown fox jumps over the lazy dog and runs away from it all day"),
    (3, "the  quick\tbrown fox jumps\nover the lazy dog and runs away from it all day"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "two words"),
    (7, "two words"),
    (None, "two words"),
    (9, "Ünï çödé text with ß and 漢字 here"),
    (10, "same word " * 50),
]


def test_fingerprints_and_groups_match_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 5000, 400)]
    rows = list(TEXTS)
    for i in range(60):
        copy = list(base)
        for at in rng.integers(0, 400, i % 8):
            copy[at] = f"new{i}"
        rows.append((100 + i, " ".join(copy)))
    rows.append((200, " ".join(f"x{i % 977}" for i in range(150_000))))
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, fp string, node string")
    got = simhash.groups(docs, spark).withColumn("hex", simhash.hex_of()).collect()
    fps = [by_hand(t) for _, t in rows]
    want = components_by_hand(fps, [i for i, _ in rows])
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r["id"], r["hex"], r["component_id"]) for r in got], key=key) == sorted(
        [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want)], key=key
    )


@pytest.mark.parametrize("lanes,radius", [(1, 3), (2, 20), (1, 0), (4, 46)])
def test_bit_sliced_links_are_all_links(lanes, radius):
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 2**63, (20, lanes)).astype(np.uint64)
    fps = seeds[rng.integers(0, 20, 700)]
    for _ in range(radius + 2):
        fps[np.arange(700), rng.integers(0, lanes, 700)] ^= np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)
    buckets = np.repeat([0, 1, 2, 3], [400, 200, 99, 1])
    got = {(int(i), int(j)) for a, b in simhash.bit_sliced_links(fps, buckets, radius) for i, j in zip(a, b)}
    gap = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    want = {
        (i, j) for i in range(700) for j in range(i + 1, 700) if buckets[i] == buckets[j] and gap[i, j] <= radius
    }
    assert got == want and want


def test_large_buckets_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 20)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    fps = sorted({centre ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 9))) for _ in range(300)})
    nodes = spark.createDataFrame(
        [(i, [f - 2**64 if f >= 2**63 else f]) for i, f in enumerate(fps)], "node long, fp array<long>"
    )
    want = components_by_hand(fps, range(len(fps)))
    for bands, radius in ((simhash.exact_bands(3), 3), (simhash.sampled_bands(64, 1, 64), 3)):
        scratch = Scratch(spark, "test")
        rows = simhash._bounded(nodes, bands, 1, scratch)
        if bands.exact:
            assert rows.where(F.col("band") > 10).count() > 0
        roots = dict(map(tuple, connected(simhash._compare(rows, 1, radius), Scratch(spark, "test")).collect()))
        assert [roots.get(i, i) for i in range(len(fps))] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs, spark).count() == 0


def test_first_of_group_keeps_rows_without_id(spark):
    docs = spark.createDataFrame(
        [(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, "d e f g"), (3, "d e f g"), (None, "a b c")],
        "doc_id long, text string",
    )
    left = simhash.first_of_group(docs, simhash.groups(docs, spark)).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 1, 3]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000), (6001, 6000), (6000, 6001)]
    edges = spark.createDataFrame(chain + star + loops, "a long, b long")
    got = dict(map(tuple, connected(edges, Scratch(spark, "test")).collect()))
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {6000: 6000, 6001: 6000}


def edited(rng, base, share, name):
    """``base`` with a run of words replaced, so that about ``share`` of all shingles are shared."""
    n = round(len(base) * (1 - 2 * share / (1 + share)))
    at = int(rng.integers(0, len(base) - n))
    return [*base[:at], *(f"{name}x{i}" for i in range(n)), *base[at + n :]]


def exact_groups(texts, similarity=0.8, words=5):
    sets = [{tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} for w in map(str.split, texts)]
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return group


@pytest.mark.parametrize("cut", [512, 7])
def test_near_groups_are_exact_among_candidates(spark, monkeypatch, cut):
    import corpus_pipeline as P

    monkeypatch.setattr(simhash, "SLICE", cut)
    rng, texts = np.random.default_rng(5), []
    for k in range(60):
        base = [f"b{k}w{i}" for i in range(200)]
        texts += [" ".join(base)] + [" ".join(edited(rng, base, s, f"e{k}s{j}")) for j, s in enumerate((0.6, 0.7, 0.76, 0.82, 0.9))]
    texts += ["spam " * 300 + " ".join(f"{x}{i}" for i in range(40)) for x in "pq"]
    base = [f"m{i}" for i in range(300)]
    texts += [" ".join(edited(rng, base, 0.95, f"g{i}")) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = simhash.near_groups(docs, spark, P.WORDS, P.RADIUS, P.LANES, P.BANDS, P.SIMILARITY).collect()
    got, want = {r["id"]: r["component_id"] for r in rows}, exact_groups(texts)
    assert len(rows) == len(texts)
    right = sum((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))
    assert all(want[i] == want[got[i]] for i in got)  # nothing below the similarity is joined
    assert right >= len(texts) * (len(texts) - 1) // 2 - 5
    assert got[361] == 361  # equal fingerprints, other shingles


def test_near_duplicates_tell_texts_of_one_id_apart(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(5, a), (5, b), (5, b), (6, a), (7, b), (None, c), (None, c), (None, c.replace("c59", "x")), (None, d), (8, d), (9, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()]
    assert sorted((i or 0, (t or "")[:1]) for i, t in left) == [(0, "c"), (5, "a"), (5, "b"), (8, "d"), (9, "")]
