"""Language identification: known words first, character n-grams for the others.

Learning counts every word of every labelled training text per language, and every
character n-gram of those words (with marks for word start and end) weighted by the
word's count. All counts are kept, as a table of words and n-grams with smoothed log
frequencies per language, so that no language loses its rare words to a larger one.

A text's score for a language is the sum over its words. A known word adds its log
frequency. An unseen one is looked up by its n-grams of the greatest length; if none is
known, by the next shorter length, down to single characters; it adds their mean log
frequency. A word of which not even a character is known adds nothing.

The table is never sent to the tasks. Documents are packed into blocks that name their words
by number and list each distinct word once. These lists are joined with the table by word;
words without a match go on as n-grams, each once however many blocks hold it. The log
frequencies return to the blocks, which stay where they are, and add up their documents.

A null text, or one without a letter, is ``und`` with score 0, as is any text when nothing
could be learned. Equal scores go to the first language by name. The score is the
language's share of the summed likelihoods. Rows are independent: repeated rows and ids are
scored alike, a null id stays null, ids may be of any type; other columns are not read. The
longest text must fit a worker.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch, slices

#: Lengths of n-grams, tried in this order.
LENGTHS = (5, 4, 3, 2, 1)
#: Entries a counter holds before it is passed on.
HELD = 300_000
#: Characters of the texts of a block.
BLOCK_CHARS = 64_000_000
#: Texts cut into words together, and their bytes; words cut into n-grams together.
TOGETHER, ROOM, WORDS = 4096, 1 << 21, 50_000
#: Words of texts scored together.
SCORED = 200_000
#: Characters of a word up to which all words are cut at once, place by place.
SHORT = 64
#: Added to every count.
ALPHA = 0.5

_LETTERS = re.compile(r"[^\W\d_]+")
#: A word that Arrow lower-cases as Python does, and signs after it.
_SIGNS = ".,:;!?"
_PLAIN = f"^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[{_SIGNS}]*$"


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str, length: int) -> list[str]:
    marked = f"<{word}>" if length > 1 else word
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


def _words_in(stretch: str) -> list[str]:
    lower = stretch.lower()
    return [lower] if lower.isalpha() else _LETTERS.findall(lower)


class _Words:
    """The words of some texts, as ``words_of``, found once per distinct stretch between spaces
    and line feeds, which no word spans. ``listed``: the distinct words; ``at``: a number per
    stretch, text after text, that start at ``starts``; ``letters``: which stretches have a letter."""

    def __init__(self, texts: pa.Array):
        cut = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        found = cut.flatten().dictionary_encode()
        self.at, self.starts, stretches = found.indices.to_numpy(), cut.offsets.to_numpy(), found.dictionary
        plain = pc.match_substring_regex(stretches, _PLAIN)
        lower = pc.utf8_lower(pc.utf8_rtrim(stretches.filter(plain), _SIGNS))
        rest = stretches.filter(pc.invert(plain)).to_pylist()
        more = [_words_in(x) for x in rest]
        words = pa.concat_arrays([lower, pa.array(list(chain.from_iterable(more)), pa.large_string())]).dictionary_encode()
        self.listed = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        plain = plain.to_numpy(zero_copy_only=False)
        self.letters, self.sizes = plain.copy(), plain.astype(np.int64)
        self.letters[~plain] = [any(map(str.isalpha, x)) for x in rest]
        self.sizes[~plain] = list(map(len, more))
        self.begins = np.cumsum(self.sizes) - self.sizes
        # The words of all stretches, one after another.
        first = np.zeros(len(words), bool)
        first[self.begins[plain]] = True
        self.words, numbers = np.zeros(len(words), np.int64), words.indices.to_numpy()
        self.words[first], self.words[~first] = numbers[: len(lower)], numbers[len(lower) :]

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of stretches one after another, and how many each has."""
        each = self.sizes[at]
        return self.words[np.repeat(self.begins[at] - np.cumsum(each) + each, each) + np.arange(each.sum())], each


def _all_grams(words: pa.Array, length: int) -> tuple[np.ndarray, pa.Array]:
    """The n-grams of all words, as ``grams_of``, and for each which word it is of."""
    marked = pc.binary_join_element_wise("<", words, ">", "") if length > 1 else words
    sizes = pc.utf8_length(marked).to_numpy()
    rest = np.flatnonzero(sizes > SHORT)
    own = [grams_of(w, length) for w in words.take(pa.array(rest)).to_pylist()]
    of, grams = [np.repeat(rest, list(map(len, own)))], [pa.array([g for x in own for g in x], pa.string())]
    which = np.flatnonzero(sizes <= SHORT)
    for at in range(SHORT):
        which = which[sizes[which] >= at + length]
        if not len(which):
            break
        of.append(which)
        grams.append(pc.utf8_slice_codeunits(marked.take(pa.array(which)), at, at + length))
    return np.concatenate(of), pa.concat_arrays(grams)


_COUNTS = "kind int, item string, lang string, n long"


def _count_words(train: DataFrame) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(n, np.int32)),
                        pa.array(list(counts), pa.string()),
                        pa.array([lang] * n, pa.string()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    names=["kind", "item", "lang", "n"],
                )
            held.clear()

        for batch in frames:
            for part in slices(batch, "text", TOGETHER, ROOM):
                for lang in part.column("lang").unique().to_pylist():
                    found = _Words(part.column("text").filter(pc.equal(part.column("lang"), lang)))
                    counts, (words, _) = held.setdefault(lang, Counter()), found.of(found.at)
                    for word, n in zip(found.listed, np.bincount(words, minlength=len(found.listed)).tolist()):
                        counts[word] += n
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return train.mapInArrow(run, _COUNTS).groupBy("kind", "item", "lang").agg(F.sum("n").alias("n"))


def _count_grams(words: DataFrame) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def counted() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            for lang in rows.column("lang").unique().to_pylist():
                own = rows.filter(pc.equal(rows.column("lang"), lang))
                for length in LENGTHS:
                    of, grams = _all_grams(own.column("item"), length)
                    grams = grams.dictionary_encode()
                    n = np.zeros(len(grams.dictionary), np.int64)
                    np.add.at(n, grams.indices.to_numpy(), own.column("n").to_numpy()[of])
                    same = [pa.array(np.full(len(n), length, np.int32)), grams.dictionary, pa.array([lang] * len(n), pa.string())]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(n)], names=["kind", "item", "lang", "n"])

        for batch in frames:
            held += [batch.select(["item", "lang", "n"])] if batch.num_rows else []
            if sum(x.num_rows for x in held) >= WORDS:
                yield from counted()
        if held:
            yield from counted()

    return words.mapInArrow(run, _COUNTS).groupBy("kind", "item", "lang").agg(F.sum("n").alias("n"))


def _tasks(spark: SparkSession) -> int:
    """Partitions for rows that are small and costly: adaptive execution would join them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Model:
    """``items``: ``(kind, item, logs)``, words (kind 0) and n-grams (kind: their length) with
    a log frequency per language of ``langs``."""

    def __init__(self, langs: list[str], items: DataFrame):
        self.langs, self.items = langs, items

    def vectors(self, words: DataFrame, scratch: Scratch) -> DataFrame:
        """``(word, logs)`` for the model's words and for those of ``words (word)`` that are
        none but have known n-grams: the mean of these. N-grams are looked up length by
        length, each only for words that no longer one has answered."""
        known = self.items.where("kind = 0").select(F.col("item").alias("word"), "logs")
        unseen = scratch.save(words.select("word").distinct().join(known, "word", "left_anti"), "unseen")
        means = F.array(*[F.avg(F.col("logs")[i]) for i in range(len(self.langs))])
        for length in LENGTHS:
            grams = _grams_of_words(unseen.repartition(_tasks(scratch.spark), "word"), length)
            hits = grams.join(self.items.where(F.col("kind") == length), "item").groupBy("word").agg(means.alias("logs"))
            hits = scratch.save(hits, f"vectors{length}")
            known = known.unionByName(hits)
            unseen = unseen.join(hits, "word", "left_anti")
        return known


def _grams_of_words(words: DataFrame, length: int) -> DataFrame:
    """``(word, item)``, a row per n-gram."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            of, grams = _all_grams(batch.column("word"), length)
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(of)), grams], names=["word", "item"])

    return words.mapInArrow(run, "word string, item string")


def _packed(told: DataFrame) -> DataFrame:
    """Rows ``(block, pos, logs)`` of a batch packed into one row per block."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if not batch.num_rows:
                continue
            block, pos = batch.column("block").to_numpy(), batch.column("pos").to_numpy().astype(np.int32)
            logs = batch.column("logs").flatten().to_numpy().astype(np.float32).reshape(len(block), -1)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            parts = np.split(order, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block[x[0]] for x in parts]),
                    pa.array([pos[x].tobytes() for x in parts], pa.binary()),
                    pa.array([logs[x].tobytes() for x in parts], pa.binary()),
                ],
                names=["block", "pos", "logs"],
            )

    return told.mapInArrow(run, "block long, pos binary, logs binary")


def learn(docs: DataFrame, spark: SparkSession, text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from all rows of ``docs`` that have a text and a language."""
    scratch = Scratch(spark, "langid")
    train = docs.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).dropna()
    counted = scratch.save(_count_words(train), "words")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    both = counted.unionByName(_count_grams(counted.repartition(_tasks(spark), "item")))
    by = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(langs)]
    items = scratch.save(both.groupBy("kind", "item").agg(F.count(F.lit(1)).alias("held"), *by), "items")
    scratch.drop("words")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs))]
    sizes = {}
    for r in items.groupBy("kind").agg(F.count(F.lit(1)).alias("items"), *sums).collect():
        sizes[r["kind"]] = [float(r[f"n{i}"] + ALPHA * (r["items"] + 1)) for i in range(len(langs))]
    if not sizes:
        return Model([], items)
    size = F.element_at(F.create_map(*[F.lit(x) for kind, s in sizes.items() for x in (kind, s)]), F.col("kind"))
    logs = F.array(*[F.log((F.col(f"n{i}") + ALPHA) / size[i]) for i in range(len(langs))])
    return Model(langs, items.select("kind", "item", logs.alias("logs")))


def _encoded(docs: DataFrame) -> DataFrame:
    """Documents ``(id, text)`` in blocks: the ids, the distinct words, and per document how
    many of them it holds, which ones and how often."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, which, times, known, size = [], [], [], [], {}, 0

        def close() -> pa.RecordBatch:
            lists = [*(pa.array(np.concatenate(x).astype(np.int32)) for x in (sizes, which, times)), pa.array(list(known), pa.string())]
            one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (pa.concat_arrays(ids), *lists)]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *one], names=["block", "ids", "sizes", "which", "times", "words"])

        for batch in frames:
            for part in slices(batch, "text", TOGETHER, min(ROOM, BLOCK_CHARS)):
                found = _Words(pc.fill_null(part.column("text"), ""))
                row = np.repeat(np.arange(part.num_rows), np.diff(found.starts))
                some = np.bincount(row, found.letters[found.at], part.num_rows) > 0
                words, each = found.of(found.at[some[row]])
                row = np.repeat(row[some[row]], each)
                used = np.bincount(words, minlength=len(found.listed)).tolist()
                numbers = np.array([known.setdefault(w, len(known)) if n else 0 for w, n in zip(found.listed, used)], np.int64)
                words = numbers[words]
                pairs, counts = np.unique(row << 32 | words, return_counts=True)
                ids.append(part.column("id"))
                sizes.append(np.bincount(pairs >> 32, minlength=part.num_rows))
                which.append((pairs & 0xFFFFFFFF).astype(np.int32))
                times.append(counts.astype(np.int32))
                size += pc.sum(pc.utf8_length(part.column("text"))).as_py() or 0
                if size > BLOCK_CHARS:
                    yield close()
                    number += 1
                    ids, sizes, which, times, known, size = [], [], [], [], {}, 0
        if sizes:
            found = words = row = used = numbers = pairs = counts = None
            pa.default_memory_pool().release_unused()
            yield close()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"block long, ids array<{kind}>, sizes array<int>, which array<int>, times array<int>, words array<string>")


def _scored(batch: pa.RecordBatch, i: int, langs: list[str]) -> pa.RecordBatch:
    """The documents of a block."""
    one = lambda name: batch.column(name).slice(i, 1).flatten()
    ids, sizes, which, times = one("ids"), *(one(c).to_numpy() for c in ("sizes", "which", "times"))
    words = np.zeros((int(which.max(initial=-1)) + 1, len(langs)))
    for piece in one("found").to_pylist():
        words[np.frombuffer(piece["pos"], np.int32)] = np.frombuffer(piece["logs"], np.float32).reshape(-1, len(langs))
    total = np.zeros((len(sizes), len(langs)))
    some, ends, at = sizes > 0, np.cumsum(sizes), 0
    while at < len(sizes):  # some texts at a time, as each of their words has a row here
        begin = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + SCORED, side="right")))
        own, part = np.flatnonzero(some[at:to]) + at, slice(begin, ends[to - 1])
        if len(own):
            total[own] = np.add.reduceat(words[which[part]] * times[part, None], (ends - sizes)[own] - begin, axis=0)
        at = to
    best = total.argmax(axis=1)
    score = 1 / np.exp(np.maximum(total - total.max(axis=1)[:, None], -700)).sum(axis=1)
    named = np.where(some, np.array(langs, object)[best], "und")
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(named.tolist(), pa.string()), pa.array(np.where(some, score, 0.0))], names=["id", "lang_pred", "score"]
    )


def predict(
    docs: DataFrame, spark: SparkSession, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, lang_pred, score)`` per row, from the text alone."""
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {picked.schema['id'].dataType.simpleString()}, lang_pred string, score double"
    langs = model.langs
    if not langs:
        return picked.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    scratch, table = Scratch(spark, "langid"), f"langid_{uuid.uuid4().hex}"
    buckets = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    writer = _encoded(picked).write.bucketBy(buckets, "block").option("path", scratch.path("blocks"))
    writer.option("compression", "zstd").saveAsTable(table)
    blocks = spark.table(table)
    listed = blocks.select("block", F.posexplode("words").alias("pos", "word"))
    told = _packed(listed.join(model.vectors(listed, scratch), "word").select("block", "pos", "logs"))
    told = told.groupBy("block").agg(F.collect_list(F.struct("pos", "logs")).alias("found"))
    both = blocks.drop("words").join(told.hint("shuffle_hash"), "block", "left")
    none = F.array().cast("array<struct<pos: binary, logs: binary>>")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what this worker kept of cutting texts
        for batch in frames:
            for i in range(batch.num_rows):
                yield _scored(batch, i, langs)

    found = scratch.save(both.withColumn("found", F.coalesce("found", none)).mapInArrow(run, schema), "result")
    spark.sql(f"DROP TABLE {table}")
    scratch.drop("blocks", "unseen", *(f"vectors{length}" for length in LENGTHS))
    return found


def accuracy(lang: Column, predicted: Column) -> Column:
    """Share of rows with a known language that are predicted right."""
    return F.avg(F.when(lang.isNotNull(), (lang == predicted).cast("int")))
