"""Roles recovered from transcripts."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from tarnwork.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, chunk string, conv string"


def conversations(n, seed=1):
    rng = np.random.default_rng(seed)
    words = lambda k: " ".join(f"w{i}" for i in rng.integers(0, 50, k))
    rows = []
    for c in range(n):
        at = 0
        if rng.random() < 0.3:
            rows.append((c, 0, "system", "You are helpful. " + words(8)))
            at = 1
        for t in range(at, at + 2 * int(rng.integers(1, 4))):
            user = (t - at) % 2 == 0
            rows.append((c, t, "user" if user else "assistant", words(6) + "?" if user else words(60) + "\n" + words(40)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_roles_of_held_out_conversations(spark):
    rows = conversations(120)
    got = chat.transcripts(frame(spark, rows).repartition(4), spark, F.col("conv") % 3 != 0).collect()
    role = {(c, t): r for c, t, r, _ in rows}
    held = [r for r in got if r["conv_id"] % 3 == 0]
    assert len(got) == len(rows) and len(held) > 50
    assert sum(role[r["conv_id"], r["turn"]] == r["role"] for r in held) / len(held) > 0.98
    assert all(r["rendered"] == f"<|{r['role']}|>\n{r['content']}\n<|end|>\n" for r in got)


def test_markers_inside_a_message(spark):
    text = "System: be brief\nHuman: what is this?\nand that?\n**Assistant:** this is\nmore of it\n\nQ: again\nA: no"
    rows = conversations(40) + [(1000, 0, None, text)]
    got = chat.transcripts(frame(spark, rows), spark, F.col("conv") < 1000).where("conv_id = 1000").orderBy("part").collect()
    assert [(r["role"], r["content"]) for r in got] == [
        ("system", "be brief"), ("user", "what is this?\nand that?"), ("assistant", "this is\nmore of it"),
        ("user", "again"), ("assistant", "no"),
    ]


def test_chunks_give_the_roles_of_one_pass(spark, monkeypatch):
    rng = np.random.default_rng(3)
    long = [(7, t, "user" if rng.random() < 0.5 else "assistant", "x " * int(rng.integers(1, 60)) + rng.choice(["?", "", "\ny"])) for t in range(500)]
    rows = conversations(30, 5) + [(c + 100, *r) for c, *r in long]
    df, counts = frame(spark, rows), {}
    learn = chat.learn
    monkeypatch.setattr(chat, "learn", lambda *a: counts.setdefault(chat.CHUNK, learn(*a)))
    whole = chat.transcripts(df, spark, F.lit(True)).collect()
    monkeypatch.setattr(chat, "CHUNK", 7)
    cut = chat.transcripts(df.repartition(5), spark, F.lit(True)).collect()
    assert counts[7].counts == counts[1024].counts

    def likelihood(found):
        roles = {(r["conv_id"], r["turn"]): r["role"] for r in found}
        model, total = counts[7], 0.0
        for conv in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
            last = None
            for m, _, seen, move in model.steps([r[3] for r in own], True):
                state = model.roles.index(roles[conv, own[m][1]])
                total += (model.start[state] if move is None else move[last, state]) + seen[state]
                last = state
        return total

    assert {tuple(r)[:3] for r in cut} == {tuple(r)[:3] for r in whole}
    assert abs(likelihood(cut) - likelihood(whole)) < 1e-6


def test_viterbi_against_all_paths():
    counts = {("start", "a"): 3, ("start", "b"): 1, ("turn", "a", "b"): 5, ("turn", "b", "a"): 2, ("turn", "b", "b"): 2, ("seen", "a", 3, True): 4, ("seen", "b", 3, False): 6}
    model = chat.Model(counts)
    texts = ["x?", "y\nz", "w?", "", "v"]
    steps = list(model.steps(texts, True))
    def score(path):
        total = 0.0
        for k, (_, _, seen, move) in enumerate(steps):
            total += (model.start[path[0]] if move is None else move[path[k - 1], path[k]]) + seen[path[k]]
        return total
    best = max(itertools.product(range(2), repeat=len(steps)), key=score)
    assert [r for *_, r in model.decode(texts, True, None, None)] == [model.roles[s] for s in best]


def test_odd_rows(spark):
    rows = [(1, None, "user", None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 1, None, "hi"), (2, 3, "assistant", "word " * 100_000)]
    got = chat.transcripts(frame(spark, rows), spark, F.lit(True)).collect()
    assert len(got) == 5 and sorted((r["conv_id"] or 0) for r in got) == [0, 1, 1, 1, 2]
    assert chat.transcripts(frame(spark, []), spark, F.lit(True)).count() == 0
    alone = chat.transcripts(frame(spark, rows), spark, F.lit(False)).collect()
    assert {r["role"] for r in alone} <= {"user", "assistant"}
