"""Token files against the tokenizer itself."""

import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnwork.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(path=PATH):
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


def odd_texts():
    rng = random.Random(4)
    bits = ["a", "Word", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "é", "漢", "'s", "'", "12", "!?", "<|endoftext|>", "​", "́"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)]


def test_word_by_word_equals_whole_texts():
    encoder, plain = tokens.Encoder(PATH), library()
    assert encoder.by_word
    texts = odd_texts()
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        want = [x.ids for x in plain.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(part)] == want


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokens.Encoder(path)
    assert not encoder.by_word
    text = "Some words of  a text"
    assert np.frombuffer(encoder.encode([text])[0], encoder.dtype).tolist() == library(path).encode(text, add_special_tokens=False).ids


def test_round_trip_in_order(spark):
    rows = [(i * 7 % 101 - 20, f"text {i} with  some words\n" * (i % 5)) for i in range(101)]
    rows += [(5, "tie"), (5, "tie"), (5, "other"), (None, "no id"), (None, None), (7, None), (8, ""), (9, "long " * 60_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start int, ids int").repartition(7)
    folder = tokens.write_tokens(docs, spark, PATH, end_id=0)
    got = sorted(map(tuple, tokens.read_tokens(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got if r[0] is None] == [None, None] and got[0][0] is None
    assert [r[0] for r in got[2:]] == sorted(i for i, _ in rows if i is not None)
    plain = library()
    want = sorted((i is not None, i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in rows if i is not None)
    mine = sorted((True, r[0], tuple(np.frombuffer(r[3], "<u4").tolist())) for r in got if r[0] is not None)
    assert mine == want
    at = 0
    for _, start, n, ids in got:
        assert start == at and len(ids) == 4 * n
        at += n


def test_crc_of_an_empty_text(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    row = tokens.read_tokens(spark, tokens.write_tokens(docs, spark, PATH)).withColumn("crc", F.crc32("ids")).first()
    assert (row["start"], row["n"], row["crc"]) == (0, 1, zlib.crc32(b"\0\0\0\0"))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_tokens(spark, tokens.write_tokens(docs, spark, PATH)).count() == 0


def test_added_tokens_get_their_ids():
    encoder, plain = tokens.Encoder(PATH, added=True), Tokenizer.from_file(PATH)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b c", "no such token here", *odd_texts()]
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts)] == want
    assert 50256 in want[0]


def test_scratch_paths_name_their_file_system(spark):
    from tarnwork.llm.common import Scratch

    assert Scratch(spark, "x").path("y").startswith("file:/")


def test_readers_drop_the_encoder_of_their_worker():
    class Shards:
        schema = "shard string"

        def mapInArrow(self, run, schema):
            return run

    tokens._encoder(PATH, True)
    assert sys.modules["_tarnwork_worker"].encoders
    assert list(tokens._write_offsets(Shards(), "/nowhere")(iter([]))) == []
    assert not hasattr(sys.modules["_tarnwork_worker"], "encoders")
    assert tokens._encoder(PATH, True).encode(["a b"])
    tokens._forget()
    tokens._forget()


def test_pieces_equal_whole_texts():
    rng = random.Random(9)
    bits = ["abc", "Éèp", "ß", "don't", "½", "²", "ж", "漢", "7", ".", ",", "!?", "...", "'", "\n", "\n\n", "\r\n", "\0", "\u0301", "ǆ", "×", "ª", "_", " ", " ", " ", "\u2028", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    for added in (False, True):
        encoder, plain = tokens.Encoder(PATH, added), Tokenizer.from_file(PATH)
        plain.encode_special_tokens = not added
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, np.uint16).tolist() for x in encoder.encode(texts)] == want
        raw, sizes = encoder.joined(pa.array([*texts, None]), b"\1\0")
        assert np.frombuffer(raw, np.uint16).tolist() == [i for ids in [*want, []] for i in [*ids, 1]]
        assert (sizes // 2).tolist() == [len(ids) + 1 for ids in want] + [1]


def test_a_piece_is_encoded_once_for_many_texts(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 0)
    encoder, asked = tokens.Encoder(PATH), []
    pieces = encoder._pieces
    monkeypatch.setattr(encoder, "_pieces", lambda new: asked.extend(new) or pieces(new))
    texts = [f"Alpha{end} beta{end} gamma{end}\nBeta gamma{end}" for end in (".", ",", "!", "") for _ in range(100)]
    assert encoder.encode(texts) == tokens.Encoder(PATH)._ids(texts)
    assert sorted(asked) == sorted(["Alpha", " beta", " gamma", "\n", "Beta", ".", ",", "!"])
