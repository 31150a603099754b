"""The registered queries of the subpackage over whole small tables."""

import zlib

import corpus_pipeline
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tarnwork.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_against_sql(name, spark, sf_dir):
    assert difference(Q.QUERIES[name](spark, sf_dir), connect(sf_dir), Q.ORACLES[name]) is None


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_simhash_against_all_pairs(spark, sf_dir):
    from test_simhash import by_hand, components_by_hand

    rows = documents(spark, sf_dir).select("doc_id", "text").collect()
    fps = [by_hand(r["text"]) for r in rows]
    want = components_by_hand(fps, [r["doc_id"] for r in rows])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in Q.op6_simhash(spark, sf_dir).collect()}
    assert got == {r["doc_id"]: (f"{f:016x}", c) for r, f, c in zip(rows, fps, want)}


def test_token_files_against_the_tokenizer(spark, sf_dir):
    from tokenizers import Tokenizer

    plain, at = Tokenizer.from_file(corpus_pipeline.tokenizer_file()), 0
    got = {r["doc_id"]: tuple(r) for r in Q.op10_token_files(spark, sf_dir).collect()}
    for r in documents(spark, sf_dir).orderBy("doc_id").collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert got.pop(r["doc_id"]) == (r["doc_id"], at, len(ids), crc)
        at += len(ids)
    assert not got


def test_language_accuracy(spark, sf_dir):
    found = Q.op4_language_id(spark, sf_dir).join(documents(spark, sf_dir), "doc_id")
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("all"), F.min("score"), F.max("score")).first()
    assert row["all"] > 0.97 and 0 <= row[1] <= row[2] <= 1
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97


def test_quality_on_held_out_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = Q.op7_quality_pu(spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    order = sum((g > b) + (g == b) / 2 for g in good for b in bad) / max(1, len(good) * len(bad))
    assert right > 0.85 and order > 0.95


def test_leaks_are_found(spark, sf_dir):
    bench = {r["item_id"]: " ".join(r["text"].split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: " ".join(r["text"].split()) for r in documents(spark, sf_dir).collect()}
    want = {(d, i) for d, text in docs.items() for i, item in bench.items() if item in text}
    got = {(r["doc_id"], r["item_id"]) for r in Q.op5_benchmark_templates(spark, sf_dir).collect()}
    assert want <= got and len(got) < 0.1 * len(docs)


def test_roles_of_messages(spark, sf_dir):
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", F.col("role").alias("told"))
    found = Q.op1_chat_formatting(spark, sf_dir).where("part = 0").join(told, ["conv_id", "turn"])
    assert found.agg(F.avg((F.col("told") == F.col("role")).cast("int"))).first()[0] > 0.9


def test_mix_counts(spark, sf_dir):
    got = Q.op2_temperature_mixing(spark, sf_dir)
    words = documents(spark, sf_dir).agg(F.sum(F.size(F.split(F.trim("text"), "\\s+")))).first()[0]
    assert 0.9 * words < got.agg(F.sum("n_tokens")).first()[0] <= 1.01 * words
    assert got.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 5


def test_pipeline_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    columns, at = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == columns
        kept[name] = {r["doc_id"] for r in at.select("doc_id").collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    everything = {r["doc_id"] for r in docs.collect()}
    assert len(good - kept["quality"]) <= 0.02 * len(good) and kept["quality"] < everything
    texts = [r["text"] for r in docs.collect() if r["doc_id"] in kept["near_duplicates"]]
    assert len(texts) == len(set(texts))
    assert kept["mixing"] <= kept["decontamination"] < kept["near_duplicates"] < kept["quality"]


def test_pipeline_run(spark, sf_dir):
    rows = sorted(Q.pipeline(spark, sf_dir).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


def test_stages_of_empty_and_odd_tables(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "Some plain words in a line.", None, None, 5), (3, "word " * 50_000, "en", "b", 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() <= 4 * len(rows)


def test_near_duplicates_of_odd_rows_by_hand(spark, sf_dir):
    """Ids that are missing, shared or repeated, texts without words and very long ones: one
    document of each group stays, found here by all pairs of five-word sets."""
    import random

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, long = [word() for _ in range(300)], [word() for _ in range(40_000)]
    near = [w if i != 150 else "changed" for i, w in enumerate(base)]
    longer = [w if i % 2000 else "changed" for i, w in enumerate(long)]
    half = base[:150] + [word() for _ in range(150)]
    texts = [
        (5, " ".join(base)), (2, " ".join(near)), (9, " ".join(base)), (None, " ".join(half)), (None, "another text with no id"),
        (None, "another text with no id"), (7, " ".join(long)), (3, " ".join(longer)), (4, None), (1, ""), (6, " "),
        (8, "one"), (8, "two"), (8, "two"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")

    def shingles(text):
        words = (text or "").split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}

    rows = list(dict.fromkeys(texts))
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    want = []
    for r in set(root):
        group = [rows[i] for i in range(len(rows)) if root[i] == r]
        want.append(min(i for i, _ in group) if all(i is not None for i, _ in group) else None)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = [r["doc_id"] for r in stage(spark, docs.repartition(4), sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
