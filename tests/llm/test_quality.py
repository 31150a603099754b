"""The positive-unlabelled classifier on made-up classes."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import quality as Q
from tarnwork.llm.common import slices


def test_risk_is_minimised_without_negatives():
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (4000, len(Q.FEATURES)))
    bad = rng.normal(0, 1, (4000, len(Q.FEATURES)))
    bad[:, 3] += 5
    prior = 0.7
    web = np.concatenate((good[:2800], bad[:1200]))
    model = Q.fit(good[2800:], web, prior)
    fresh = rng.normal(0, 1, (1000, len(Q.FEATURES)))
    assert (model.score(fresh) > 0.5).mean() > 0.95
    fresh[:, 3] += 5
    assert (model.score(fresh) < 0.3).mean() > 0.8


def test_features_of_odd_texts():
    for text in (None, "", " \n ", "!", "a" * 100_000, "ß漢\U0001f600 " * 3, "\ud800"):
        assert len(Q.describe(text)) == len(Q.FEATURES) and np.isfinite(Q.describe(text)).all()
    assert Q.describe(None) == Q.describe("")
    shares = dict(zip(Q.FEATURES, Q.describe("Ab cd cd 12 $$")))
    assert shares["doubled"] == pytest.approx(1 / 5) and shares["upper_letters"] == pytest.approx(1 / 6)
    assert shares["digits"] == pytest.approx(2 / 14) and shares["symbols"] == pytest.approx(2 / 14)


def rows(n):
    good = [(i, f"Plain words of a text with number {i}.\nAnd a second line of it.", 1) for i in range(n)]
    return good + [(n + i, f"### {i} $$$ %%% ### $$$ {i}", 0) for i in range(n // 5)]


def test_learning_and_scores(spark):
    data = rows(300)
    docs = spark.createDataFrame([(i, t, 3.0, [1.0]) for i, t, _ in data], "doc_id long, text string, score double, features array<double>")
    labels = spark.createDataFrame([(i, y) for i, _, y in data if i % 2] + [(1, None), (None, 1), (9999, 1)], "id long, quality int")
    model = Q.learn(docs, labels, spark, positives=100, unlabelled=200)
    assert model.prior == pytest.approx(151 / 181)
    scores = {r["id"]: r["score"] for r in Q.score(docs, spark, model).collect()}
    assert all((scores[i] >= 0.3) == (y == 1) for i, _, y in data)
    whole = Q.with_scores(docs, spark, model, name="__s")
    assert whole.columns == [*docs.columns, "__s"] and whole.where("score = 3.0").count() == len(data)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None), (1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "id long, quality int")
    assert Q.learn(docs, none, spark).prior == 0.5
    bad = spark.createDataFrame([(1, 0)], "id long, quality int")
    got = Q.score(docs, spark, Q.learn(docs, bad, spark)).collect()
    assert sorted((r["id"] or 0, r["score"]) for r in got) == [(0, 0.0), (1, 0.0), (1, 0.0)]
    empty = docs.where(F.lit(False))
    assert Q.score(empty, spark, Q.learn(empty, none, spark)).count() == 0


def risk_by_hand(w, positive, unlabelled, prior, ridge=1e-6):
    """Non-negative risk, one row after the other, with its ridge."""
    loss = lambda rows, sign: sum(math.log1p(math.exp(-sign * float(r @ w))) for r in rows) / len(rows)
    negative = loss(unlabelled, -1) - prior * loss(positive, -1)
    return prior * loss(positive, 1) + max(0.0, negative) + ridge / 2 * float(w @ w), negative


def sample_of_two_kinds(seed):
    rng = np.random.default_rng(seed)
    n = len(Q.FEATURES)
    good, bad = rng.normal(1, 1, (60, n)), rng.normal(-1, 1, (90, n))
    return good[:30], np.concatenate((good[30:], bad))


@pytest.mark.parametrize("prior", [0.1, 0.3, 0.9])
def test_first_step_follows_the_slope_of_the_risk(prior):
    """From zero weights the first step goes 0.1 against the sign of the slope; where the
    negative part of the risk is below zero, along that part's own slope."""
    positive, unlabelled = sample_of_two_kinds(3)
    model = Q.fit(positive, unlabelled, prior, steps=1)
    p, u = model.design(positive), model.design(unlabelled)
    zero = np.zeros(p.shape[1])
    _, negative = risk_by_hand(zero, p, u, prior)
    part = (lambda w: risk_by_hand(w, p, u, prior)[0]) if negative >= 0 else (lambda w: -risk_by_hand(w, p, u, prior)[1])
    for j in range(0, len(zero), 7):
        step = np.zeros(len(zero))
        step[j] = 1e-5
        slope = (part(zero + step) - part(zero - step)) / 2e-5
        want = -0.1 * slope / (abs(slope) + 1e-8) if abs(slope) > 1e-6 else 0.0
        assert model.weights[j] == pytest.approx(want, abs=1e-3)


def test_fitted_weights_are_not_beaten_nearby():
    positive, unlabelled = sample_of_two_kinds(4)
    model = Q.fit(positive, unlabelled, 0.3)
    p, u = model.design(positive), model.design(unlabelled)
    least, _ = risk_by_hand(model.weights, p, u, 0.3)
    assert least < risk_by_hand(np.zeros(p.shape[1]), p, u, 0.3)[0] / 2
    rng = np.random.default_rng(5)
    for scale in (0.01, 0.1, 1.0):
        for _ in range(10):
            near = model.weights + scale * rng.normal(size=len(model.weights))
            assert risk_by_hand(near, p, u, 0.3)[0] > least - 5e-3


class Frame:
    """Hands back the function that would run in the tasks."""

    def __init__(self, schema):
        self.schema = schema

    def mapInArrow(self, run, schema):
        return run


def test_texts_of_a_batch_are_scored_in_parts(spark):
    data = [(i, None if i % 9 == 0 else f"word {i} " * (i % 5)) for i in range(1300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    model = Q.Model(0.3, np.zeros((len(Q.FEATURES), Q.BINS - 1)), np.linspace(-1, 1, len(Q.FEATURES) * Q.BINS + 1))
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in data], "text": [t for _, t in data]})
    parts = list(Q.with_scores(Frame(docs.schema), spark, model)(iter([batch, batch.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= 512
    whole = pa.Table.from_batches(parts)
    assert whole.column("doc_id").to_pylist() == [i for i, _ in data]
    assert whole.column("score").to_pylist() == pytest.approx(model.score(np.array([Q.describe(t) for _, t in data])).tolist())


def test_parts_are_bounded_by_their_text():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 60, "b" * 60, None, "c" * 500, "", "d" * 99, "e" * 2]})
    parts = [p.column("text").to_pylist() for p in slices(batch.slice(1), room=100, rows=3)]
    assert [len(p) for p in parts] == [2, 1, 2, 1] and sum(parts, []) == batch.column("text").to_pylist()[1:]
