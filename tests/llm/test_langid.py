"""Language scores against the definition."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import langid as L
from tarnwork.llm.common import Scratch

TEXTS = [
    (1, "the cat and the dog sat on the mat", "en"), (2, "the end of the day", "en"), (3, "der hund und die katze", "de"),
    (4, "das ende der welt und der tage", "de"), (5, "le chat et le chien", "fr"), (6, None, "en"), (7, "lost", None), (8, "", "fr"),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n long, item string")


def by_hand(word, langs):
    counts = {0: Counter(), **{n: Counter() for n in L.LENGTHS}}
    for _, text, lang in TEXTS:
        if text and lang:
            for w in text.split():
                counts[0][w, lang] += 1
                for n in L.LENGTHS:
                    for g in L.grams_of(w, n):
                        counts[n][g, lang] += 1
    def logs(kind, item):
        kinds = {i for i, _ in counts[kind]}
        total = {x: sum(c for (_, y), c in counts[kind].items() if y == x) for x in langs}
        return [math.log((counts[kind][item, x] + L.ALPHA) / (total[x] + L.ALPHA * (len(kinds) + 1))) for x in langs]
    if any(i == word for i, _ in counts[0]):
        return logs(0, word)
    for n in L.LENGTHS:
        known = [g for g in L.grams_of(word, n) if any(i == g for i, _ in counts[n])]
        if known:
            return [sum(c) / len(known) for c in zip(*(logs(n, g) for g in known))]
    return [0.0] * len(langs)


def test_words_first_then_shorter_grams(spark):
    model = L.learn(frame(spark), spark)
    assert model.langs == ["de", "en", "fr"]
    words = ("the", "und", "undz", "thecat", "xq", "ж", "chatz")
    asked = spark.createDataFrame([(w,) for w in words] * 3, "word string").repartition(3)
    got = {r["word"]: r["logs"] for r in model.vectors(asked, Scratch(spark, "x")).collect()}
    assert "ж" not in got
    for word in words:
        assert got.get(word, [0.0] * 3) == pytest.approx(by_hand(word, model.langs))


def test_texts_in_blocks_by_hand(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 40)
    model = L.learn(frame(spark), spark)
    texts = [" ".join(("the", "dog", "undz", "chatz", "ж", "Katze")[i % 6 : i % 6 + 1 + i % 4]) for i in range(40)]
    rows = [(i, t, None) for i, t in enumerate(texts)]
    got = {r["id"]: r for r in L.predict(frame(spark, rows).repartition(3), spark, model).collect()}
    assert len(got) == 40
    for i, t in enumerate(texts):
        total = [sum(x) for x in zip(*(by_hand(w, model.langs) for w in L.words_of(t)))]
        best = max(total)
        assert got[i]["lang_pred"] == model.langs[total.index(best)]
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(x - best) for x in total), rel=1e-4)


def test_a_rare_language_keeps_its_words(spark):
    """One row in a thousand, words that occur once: predicted as with equal shares."""
    def text(alphabet, i):
        return " ".join("".join(alphabet[(i * 7 + j * j + k * 3) % len(alphabet)] for k in range(6)) for j in range(12))

    large = spark.range(4000).select(F.col("id"), F.concat(F.lit("the word number "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit("en").alias("lang"))
    small = spark.createDataFrame([(10_000 + i, text("aeioulmnrst", i), "xx") for i in range(4)], "id long, text string, lang string")
    model = L.learn(large.unionByName(small), spark)
    asked = spark.createDataFrame([(i, " ".join(text("aeioulmnrst", i).split()[:5])) for i in range(4)], "doc_id long, text string")
    assert {r["lang_pred"] for r in L.predict(asked, spark, model).collect()} == {"xx"}
    words = spark.createDataFrame([(w,) for i in range(4) for w in text("aeioulmnrst", i).split()], "word string").distinct()
    assert model.items.where("kind = 0").join(words, F.col("item") == F.col("word"), "left_semi").count() == words.count()


def test_predictions_and_odd_rows(spark):
    model = L.learn(frame(spark), spark)
    rows = [(1, "The DOG and the cat!", None), (2, None, "en"), (3, "", "en"), (4, "123 -- ?", "de"), (5, "ж", "fr"), (6, "und " * 100_000, "en"), (None, "le chien", None), (1, "The DOG and the cat!", None), (7, "½ ² ³ Ⅷ", "en")]
    got = {(r["id"], r["lang_pred"]) for r in L.predict(frame(spark, rows), spark, model).collect()}
    assert got == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (6, "de"), (None, "fr"), (7, "und")}
    scores = {r["id"]: r["score"] for r in L.predict(frame(spark, rows), spark, model).collect()}
    assert scores[2] == 0 and abs(scores[5] - 1 / 3) < 1e-9 and all(0 <= s <= 1 for s in scores.values())


def test_nothing_to_learn_from(spark):
    empty = frame(spark, [])
    model = L.learn(empty, spark)
    assert L.predict(empty, spark, model).count() == 0
    assert [tuple(r) for r in L.predict(frame(spark, TEXTS[:1]), spark, model).collect()] == [(1, "und", 0.0)]


def test_grams_of_many_words_at_once():
    words = ["a", "", "été", "straße", "漢字", "x" * 61, "y" * 62, "z" * 63, "ab" * 400, "a"]
    for length in L.LENGTHS:
        of, grams = L._all_grams(pa.array(words), length)
        got = sorted(zip(of.tolist(), grams.to_pylist()))
        assert got == sorted((i, g) for i, w in enumerate(words) for g in L.grams_of(w, length))


def test_words_of_many_texts_equal_words_of_each():
    texts = ["ΟΔΟΣ ΣΑΣ. Σ ΑΣ'Α", "İstanbul I", "One two.\nTHREE  four_5 six7seven ", "½ ²x", "", " ", "\u2028a\xa0b", "ÀÉß Ÿ×Þ÷ ÿ?! Äa-Öb", "a.b. ..c", "ẞ Ǆ Σ\nΣ"]
    found = L._Words(pa.array(texts))
    for i, text in enumerate(texts):
        at = found.at[found.starts[i] : found.starts[i + 1]]
        assert [found.listed[k] for k in found.of(at)[0]] == L.words_of(text)
        assert found.letters[at].any() == any(map(str.isalpha, text))
    every = "".join(c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff")
    texts = [f"{c} x{c}. {c}y" for c in every]
    found = L._Words(pa.array(texts))
    assert [found.listed[k] for k in found.of(found.at)[0]] == [w for t in texts for w in L.words_of(t)]


def test_a_stretch_is_cut_once_for_many_texts(spark, monkeypatch):
    """The work per word is done for distinct ones: here ten, in 500 texts."""
    class Rows:
        schema = {"id": type("Field", (), {"dataType": type("Type", (), {"simpleString": lambda self: "bigint"})()})()}

        def mapInArrow(self, run, schema):
            return run

    cut, asked = L._words_in, []
    monkeypatch.setattr(L, "_words_in", lambda x: asked.append(x) or cut(x))
    monkeypatch.setattr(L, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})())}))
    texts = [" ".join(f"word-{'abcdefghij'[(i + j) % 10]}." for j in range(30)) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(502)), pa.array([*texts, "½ 7", None])], names=["id", "text"])
    (block,) = L._encoded(Rows())(iter([batch]))
    assert sum(x.startswith("word") for x in asked) == 10 and block.column("block")[0].as_py() == 3 << 32
    assert block.column("times")[0].as_py() == [30, *[3] * 10] * 500 and block.column("sizes")[0].as_py() == [11] * 500 + [0, 0]
    assert len(block.column("words")[0]) == 11  # none of a text without a letter
    words, which = block.column("words")[0].as_py(), np.array(block.column("which")[0].as_py()).reshape(500, 11)
    assert all({words[k] for k in row} == set(L.words_of(t)) for row, t in zip(which, texts))
