"""Template windows against a search by hand."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tarnwork.llm import decontaminate as D

ITEM = "A train leaves Paris at 9:30 with Alice Miller aboard and covers 240 km in 3 hours before Alice gets off. How fast was it?"
BENCH = [
    (1, ITEM),
    (2, "the sum of all odd natural numbers below this bound equals a perfect square"),
    (3, "short but five tokens long here"),
    (4, "too few words"),
    (5, None),
    (6, ""),
    (7, "12 13 14 15 16 17 18 19 20 21"),
]


def doc(*parts):
    return " ".join(parts)


FILL = "nothing of any interest is said in these words that stand around it and go on"
OTHER = ITEM.replace("Paris", "London").replace("9:30", "10:15").replace("Alice", "Berta").replace("Miller", "Jones").replace("240", "95").replace(" 3 ", " 7 ")
DOCS = [
    (10, doc(FILL, ITEM, FILL)),
    (11, doc(FILL, OTHER, FILL)),
    (12, doc(FILL, ITEM.replace("before Alice", "before Carla"))),
    (13, doc("Foo", ITEM.upper().replace("ALICE", "Alice").replace("MILLER", "Miller").replace("PARIS", "Paris"))),
    (14, doc(FILL, "The Sum of all odd natural; numbers below\n\nthis bound -- equals a perfect square!")),
    (15, doc("covers 240 km in 3 hours", FILL)),
    (16, doc(FILL, "Short, but five tokens long here.", FILL)),
    (17, "too few words"),
    (18, "12 13 14 15 16 17 18 19 20 21"),
    (19, None),
    (20, ""),
    (21, " ".join(f"w{i}" for i in range(100_000)) + " " + ITEM),
    (None, doc(FILL, ITEM)),
    (10, doc(FILL, ITEM, FILL)),
    (10, FILL),
]


def found(spark, docs=DOCS, bench=BENCH):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, h int, item_id string")
    b = spark.createDataFrame([(*r, 1) for r in bench], "item_id long, text string, h int")
    return d, D.contaminated(d, b, spark)


def test_kinds_of_leaks(spark):
    docs, hits = found(spark)
    got = {(r["id"], r["item_id"], r["kind"]) for r in hits.collect()}
    assert got == {
        (10, 1, "verbatim"), (11, 1, "reparameterised"), (13, 1, "verbatim"), (14, 2, "verbatim"),
        (16, 3, "verbatim"), (21, 1, "verbatim"), (None, 1, "verbatim"),
        (12, 1, "verbatim"),
    }
    slots = {s["item"]: s["document"] for r in hits.where("id = 11").collect() for s in r["slots"]}
    assert slots == {"Paris": "London", "9:30": "10:15", "Alice": "Berta", "Miller": "Jones", "240": "95", "km": "km", "3": "7", "hours": "hours"}
    left = sorted((r["doc_id"] for r in D.without_contaminated(docs, hits).collect()), key=lambda x: x or 0)
    assert 10 in left and left.count(10) == 1 and {15, 17, 18, 19, 20} <= set(left) and None not in left


def test_inconsistent_slots_do_not_match(spark):
    _, hits = found(spark, [(1, doc(FILL, OTHER.replace("before Berta", "before Dora"), FILL))])
    assert hits.count() == 0


def test_verbatim_leaks_against_all_windows(spark):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in rng.integers(0, 300, n))
    bench = [(i, text(int(rng.integers(6, 40)))) for i in range(40)]
    docs = [(i, text(60)) for i in range(60)]
    for i, (item, t) in enumerate(bench):
        words = t.split()
        part = words[: int(rng.integers(5, len(words) + 1))]
        docs.append((100 + i, text(20) + " " + " ".join(part) + " " + text(15)))
    tok = lambda s: re.findall(r"\w+", s)
    want = set()
    for key, d in docs:
        dw = tok(d)
        for item, t in bench:
            iw = tok(t)
            width = min(8, len(iw))
            need = min(6, max(1, len(iw) - width))
            for diagonal in range(-len(iw), len(dw)):
                runs = sum(
                    1 for p in range(len(iw) - width + 1)
                    if 0 <= p + diagonal <= len(dw) - width and dw[p + diagonal : p + diagonal + width] == iw[p : p + width]
                )
                if runs >= need:
                    want.add((key, item))
    _, hits = found(spark, docs, bench)
    assert {(r["id"], r["item_id"]) for r in hits.collect()} == want and len(want) > 15


def test_empty_tables(spark):
    assert found(spark, [], BENCH)[1].count() == 0
    assert found(spark, DOCS, [])[1].count() == 0


def test_copies_of_items_rich_in_values(spark):
    bench = [
        (1, "What is 12 * 7 + 3 ?"), (2, "12 13 14 15 16 17 18 19 20 21"),
        (3, "Anna Berta Carla Dora 5 6 7 8 9 10 11 12 13 in all of these rows of numbers"),
    ]
    docs = [(i, doc(FILL, text, FILL)) for i, text in bench] + [
        (4, doc(FILL, "What is 12 * 7 + 4 ?", FILL)), (5, "12 13 14 15 16 17 18 91 20 21"), (6, FILL),
        (7, "Anna Berta Carla Dora 5 6 7 8 9 10 11 12 14 in none of those rows"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["id"], r["item_id"], r["kind"]) for r in D.contaminated(d, b, spark, exact=True).collect()}
    assert got == {(1, 1, "verbatim"), (2, 2, "verbatim"), (3, 3, "verbatim")}


def test_names_that_open_sentences(spark):
    bench = [
        (1, "Alice bought 12 apples at the shop for 3 dollars. Bob sold 5 pears for 2 dollars."),
        (2, "McDonald walked 4 miles to the old mill. O'Neil ran 9 miles from there to town. Then both took a bus home."),
    ]
    docs = [
        (1, "Berta bought 15 apples at the shop for 4 dollars. Carl sold 7 pears for 3 dollars."),
        (2, doc(FILL + ".", "MacArthur walked 6 miles to the old mill. O'Hara ran 3 miles from there to town. Then both took a bus home.")),
        (3, "Berta bought 15 apples at the shop for 4 dollars. Carl ate 7 plums for 3 dollars."),
        (4, bench[0][1]),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    hits = D.contaminated(d, b, spark, exact=True).collect()
    got = {(r["id"], r["item_id"], r["kind"]) for r in hits}
    assert got == {(1, 1, "reparameterised"), (2, 2, "reparameterised"), (4, 1, "verbatim")}
    slots = {s["item"]: s["document"] for r in hits if r["id"] == 1 for s in r["slots"]}
    assert slots["Alice"] == "Berta" and slots["Bob"] == "Carl"


def test_bitmap_of_words_grows_with_them(spark):
    assert D._word_bits(0) == D._word_bits(1000) == D.FILTER_BITS
    words = 400_000
    bits = D._word_bits(words)
    assert D.ROOM * words <= bits <= 2 * D.ROOM * words
    rows = spark.range(words).select(F.xxhash64("id").alias("h"))
    bitmap = np.frombuffer(D._bitmap(rows, bits), np.uint8)
    held = np.array([r["h"] for r in rows.limit(1000).collect()], np.int64).view(np.uint64)
    other = np.random.default_rng(3).integers(0, 2**63, 100_000).astype(np.uint64)
    assert D._in_bitmap(bitmap, held).all() and D._in_bitmap(bitmap, other).mean() < 1.2 / D.ROOM


def test_texts_are_taken_together(spark, monkeypatch):
    texts = [t for _, t in DOCS[:-4]] + ["", " \n ", "Bob. 5 km", "12", "km in \x1c one"] * 40 + [OTHER, None, "mm"]
    together, alone = D.Templates(), D.Templates()
    names = lambda x, at: [x.value(i) for i in at]
    tokens, literal, at, opening, text = together.of(pa.array(texts))
    for i, one in enumerate(texts):
        own, here = alone.of(pa.array([one], pa.string())), text == i
        assert [x.tolist() for x in (tokens[here], literal[here], opening[here])] == [own[k].tolist() for k in (0, 1, 3)]
        assert names(together, at[here]) == names(alone, own[2])
    calls = []
    monkeypatch.setattr(D, "window_hashes", lambda *a, f=D.window_hashes: calls.append(1) or f(*a))

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "tie": [0] * len(texts), "text": texts})
    rows = [r for b in D._run_table(Rows(), None, 8, 5, b"", None, set(range(5, 9)))(iter([batch])) for r in b.to_pylist()]
    assert {r["id"] for r in rows} >= {0, 1, len(texts) - 3} and all(r["width"] <= 8 for r in rows)
    assert len(calls) <= 12
