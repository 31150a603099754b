"""Lines shared by documents against a version written in plain Python."""

import random

from pyspark.sql import functions as F

from tarnwork.llm import lines as L

SCHEMA = "doc_id long, text string, n_lines string"
SPACE = " \t\n\x0b\x0c\r"


def by_hand(rows, least, documents):
    """``{(id, text): (n_lines, n_dropped, kept)}``."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    holders = {}
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    top = {k: max(h, key=lambda i: (i is not None, i or 0)) for k, h in holders.items() if len(h) >= documents}
    out = {}
    for i, text, _ in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if key(x) not in top or top[key(x)] == i]
        out[i, text] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out


def found(spark, rows, least, documents):
    docs = spark.createDataFrame(rows, SCHEMA)
    return L.without_repeats(docs, L.bitmaps(docs, spark, least, documents)).collect()


def test_odd_rows(spark):
    shared = "a line of more than ten points Ä"
    rows = [
        (1, f"{shared}\nshort\n{shared}", "x"),
        (1, f"{shared}\nshort\n{shared}", "x"),
        (1, f"own\n\n{shared}", None),
        (2, f" \t{shared.upper().replace('Ä', 'Ä')}\r\n", ""),
        (3, f"{shared}\n" * 200, ""),
        (4, f"{shared.replace('Ä', 'ä')}\nlast", ""),
        (None, f"{shared}\nwithout an id", ""),
        (None, "short", ""),
        (-5, None, ""),
        (6, "", ""),
        (7, "\n", ""),
        (8, "　" + shared, ""),
    ]
    want = by_hand(rows, 10, 3)
    got = found(spark, rows, 10, 3)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_lines"], r["n_dropped"], r["kept"]) == want[r["doc_id"], r["text"]]
    assert any(r["n_dropped"] for r in got) and sum(r["n_dropped"] for r in got if r["doc_id"] == 3) == 0


def test_random_texts_and_a_hot_line(spark, monkeypatch):
    monkeypatch.setattr(L, "PARTS", 16)
    monkeypatch.setattr(L, "WHOLE", 4)
    rng = random.Random(1)
    pool = [f"common line number {i} of all" for i in range(40)]
    rows = []
    for i in range(400):
        picked = rng.choices(pool, [2.0**-k for k in range(40)], k=rng.randrange(0, 150))
        rows.append((i if i % 7 else None, "\n".join(picked) if picked else None, ""))
    want = by_hand(rows, 10, 5)
    got = found(spark, rows, 10, 5)
    assert {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"], r["kept"]) for r in got} == want


def test_empty_table_and_text_ids(spark):
    assert found(spark, [], 10, 2) == []
    docs = spark.createDataFrame([("b", "the same long line"), ("a", "the same long line"), ("a ", "x")], "name string, body string")
    got = L.without_repeats(docs, L.bitmaps(docs, spark, 10, 2, "name", "body"), "name", "body")
    assert {r["name"]: r["kept"] for r in got.collect()} == {"b": "the same long line", "a": "", "a ": "x"}


def test_bitmap_words(spark):
    gone = [0, 1, 63, 64, 700]
    dropped = spark.createDataFrame([(1, 9, i) for i in gone], "id long, tag long, line int")
    row = L.keep_bitmaps(dropped).withColumn("gone", L.dropped_of(F.col("keep"))).first()
    assert row["gone"] == gone and row["n_dropped"] == 5
    assert [w["word"] for w in row["keep"]] == [0, 1, 10]
