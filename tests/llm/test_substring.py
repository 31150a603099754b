"""Repeated passages against a dictionary of all windows."""

import re
from collections import Counter

import numpy as np
import pytest

from tarnwork.llm import substring


def by_hand(texts, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def sample():
    rng = np.random.default_rng(5)
    text = lambda n, v=400: " ".join(f"w{i}é" for i in rng.integers(0, v, n))
    passage, other = text(60), text(36)
    texts = [text(300) for _ in range(30)]
    texts += [text(50) + "\n" + passage + "\t" + text(40), passage, passage.replace(" ", "  "), text(10) + " " + passage]
    texts += [other[:40], other + " " + text(5) + " " + other, "again " * 200, "a b " * 30, None, "", " \n", "one"]
    texts += ["x" * 100_000, " no break " * 40, text(120_000, 10**6)]
    return texts + texts[:3]


@pytest.mark.parametrize("width,block", [(35, 1 << 23), (35, 2000), (5, 500), (1, 2000)])
def test_removal_matches_all_windows(spark, width, block):
    texts = sample()
    rows = [(i % 40, t, "b", "l") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, line string").repartition(5)
    repeats = substring.Repeats(spark, width, block_bytes=block, slice_windows=50_000)
    got = [tuple(r) for r in repeats.removed(docs).select("id", "n_words", "n_removed", "kept", "spans").collect()]
    repeats.close()
    want = [(i % 40, *x) for i, x in enumerate(by_hand(texts, width))]
    assert sorted(g[:4] for g in got) == sorted(want)
    for _, n, gone, _, spans in got:
        assert sum(s["to"] - s["from"] for s in spans) == gone and all(0 <= s["from"] < s["to"] <= n for s in spans)


def test_estimates_are_never_too_low(spark):
    texts = sample()[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring.Repeats(spark, 10, block_bytes=3000, cells=64).removed(docs).select("n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(texts, 10))


def test_hashing_in_parts_changes_nothing():
    line = " ".join(f"word{i}" for i in range(3000)).encode()
    starts, ends = substring.word_bounds(line)
    whole, parts = (substring.word_hashes(line, starts, ends, n) for n in (1 << 20, 100))
    assert (whole == parts).all() and len(set(whole.tolist())) == 3000


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring.Repeats(spark).removed(empty).count() == 0
    some = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in substring.Repeats(spark, 3).removed(some).collect()] == [(None, 3, 3)] * 2
