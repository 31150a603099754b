"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are drawn, ``positives`` and ``unlabelled``
rows at most (a bounded, documented sample, taken by the hash of the id), described by
``FEATURES`` of the whole text, and a logistic model over binned features is fitted to
the non-negative unbiased risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

by gradient steps; where the part inside the maximum turns negative, the step raises it
again. The class prior is the share of positives among all trusted labels. Labels of the
negative class serve for that prior only.

Every text is scored, empty and null ones as texts without words. With no positive to
learn from, every score is the prior, or one half where there are no labels at all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import slices

FEATURES = (
    "log_words", "mean_word", "short_words", "long_words", "distinct", "doubled", "unlettered", "odd_ends",
    "upper_letters", "title_words", "digits", "symbols", "punctuation", "stops", "lines", "line_words", "same_lines",
    "commonest",
)
#: Bins per feature, cut at quantiles of the sample.
BINS = 10

_PUNCTUATION = ".,;:!?'\"()-"
_ODD_END = re.compile(r"(?:[^\w\s.,;:?'\")\-]|!!)$")

_LETTER, _UPPER, _DIGIT, _SIGN, _OTHER = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    """Kinds of the first 65,536 characters; those beyond count as other signs."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            table[code] = _LETTER | (_UPPER if c.isupper() else 0)
        elif c.isdigit():
            table[code] = _DIGIT
        elif not c.isspace():
            table[code] = _SIGN if c in _PUNCTUATION else _OTHER
    return table


_TABLE: list[np.ndarray] = []


def _shares(text: str) -> tuple[int, ...]:
    """How many characters of each kind a text has."""
    if not _TABLE:
        _TABLE.append(_kinds())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(_TABLE[0][np.minimum(codes, (1 << 16) - 1)], minlength=32)
    has = lambda bit: int(counts[np.arange(len(counts)) & bit > 0].sum())
    return has(_LETTER), has(_UPPER), has(_DIGIT), has(_SIGN), has(_OTHER)


def describe(text: str | None) -> list[float]:
    """The features of one text."""
    text = text or ""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    kinds = set(words)
    counts: dict[str, int] = {}
    doubled, last = 0, None
    for w in words:
        counts[w] = counts.get(w, 0) + 1
        doubled += w == last
        last = w
    lengths = [len(w) for w in words]
    letters, upper, digits, signs, other = _shares(text)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(len(words)),
        sum(lengths) / n,
        sum(x <= 3 for x in lengths) / n,
        sum(x >= 12 for x in lengths) / n,
        math.log1p(len(kinds)) / math.log1p(n),
        doubled / n,
        sum(c for w, c in counts.items() if not w[0].isalpha() and not w[-1].isalpha()) / n,
        sum(c for w, c in counts.items() if _ODD_END.search(w)) / n,
        upper / max(1, letters),
        sum(c for w, c in counts.items() if w.istitle()) / n,
        digits / chars,
        other / chars,
        signs / chars,
        sum(c for w, c in counts.items() if w[-1] in ".!?") / n,
        len(lines) / n,
        math.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        max(counts.values(), default=0) / n,
    ]


def described(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, features)`` per row."""
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in frames for p in slices(batch)):
            rows = [describe(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(rows, pa.list_(pa.float64()))], names=["id", "features"]
            )

    return picked.mapInArrow(run, "id long, features array<double>")


@dataclass
class Model:
    prior: float
    cuts: np.ndarray | None = None
    weights: np.ndarray | None = None

    def design(self, features: np.ndarray) -> np.ndarray:
        """One column per feature and bin, and a constant."""
        wide = np.zeros((len(features), len(FEATURES) * BINS + 1))
        wide[:, -1] = 1
        for j in range(len(FEATURES)):
            at = np.searchsorted(self.cuts[j], features[:, j], side="right")
            wide[np.arange(len(features)), j * BINS + at] = 1
        return wide

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        return _logistic(self.design(features) @ self.weights)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2000, ridge: float = 1e-6) -> Model:
    """Minimise the non-negative risk with Adam over the whole sample."""
    both = np.concatenate((positive, unlabelled))
    cuts = np.quantile(both, np.arange(1, BINS) / BINS, axis=0).T
    model = Model(prior, cuts)
    p, u = model.design(positive), model.design(unlabelled)
    w = np.zeros(p.shape[1])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        gp, gu = p @ w, u @ w
        # l(g) = log(1 + exp(-g)); its slope is -(1 - s), that of l(-g) is s.
        sp, su = _logistic(gp), _logistic(gu)
        as_positive = -prior * (1 - sp) @ p / len(p)
        as_negative = su @ u / len(u) - prior * (sp @ p) / len(p)
        inner = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        slope = (as_positive + as_negative if inner >= 0 else -as_negative) + ridge * w
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        w = w - 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    model.weights = w
    return model


def learn(
    docs: DataFrame,
    labels: DataFrame,
    spark: SparkSession,
    positives: int = 8_000,
    unlabelled: int = 12_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Fit on ``docs`` with ``labels (id, quality)``, both already cut to what may be
    learned from. At most ``positives + unlabelled`` rows come to the driver, as features.
    A row may be drawn for both; an id labelled twice counts by its larger label."""
    known = labels.where(F.col("id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("id").agg(F.max("quality").alias("quality"))
    prior = known.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]
    if prior is None:
        return Model(0.5)
    ids = docs.select(F.col(id_column).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    order = [F.xxhash64("id"), "id"]
    trusted = known.where("quality = 1").join(ids, "id").orderBy(*order).limit(positives)
    web = ids.orderBy(*order).limit(unlabelled)
    drawn = trusted.select("id", F.lit(1).alias("drawn")).unionByName(web.select("id", F.lit(0).alias("drawn")))
    wanted = [tuple(r) for r in drawn.collect()]
    if not any(d for _, d in wanted):
        return Model(float(prior))
    # The sample is bounded by the parameters, so it may be broadcast.
    chosen = spark.createDataFrame([(i,) for i in {i for i, _ in wanted}], "id long")
    sample = docs.join(F.broadcast(chosen), docs[id_column] == chosen["id"], "left_semi")
    first = described(sample, id_column, text_column).groupBy("id").agg(F.min("features").alias("features"))
    found = {r["id"]: r["features"] for r in first.collect()}
    pick = lambda kind: np.array([found[i] for i, d in wanted if d == kind])
    return fit(pick(1), pick(0), float(prior))


def score(
    docs: DataFrame, spark: SparkSession, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` columns aside, ``(id, score)`` per row, from the text alone."""
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sent = spark.sparkContext.broadcast((model.prior, model.cuts, model.weights))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in frames for p in slices(batch)):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(_scores(Model(*sent.value), part.column("text")))], names=["id", "score"]
            )

    return picked.mapInArrow(run, "id long, score double")


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    rows = np.array([describe(t) for t in texts.to_pylist()]).reshape(-1, len(FEATURES))
    return model.score(rows)


def with_scores(docs: DataFrame, spark: SparkSession, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score column, for use as a filter."""
    sent = spark.sparkContext.broadcast((model.prior, model.cuts, model.weights))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in frames for p in slices(batch, text_column)):
            scores = pa.array(_scores(Model(*sent.value), part.column(text_column)))
            yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{name}` double")
