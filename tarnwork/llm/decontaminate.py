"""Benchmark decontamination by templates, to catch re-parameterised questions too.

Tokens become template tokens: numbers, number-unit pairs, units after a number and names
(title-case words inside a sentence that the benchmark never writes in lower case) are typed
placeholders, everything else is its lower case without outer punctuation. Runs of ``width`` template tokens are hashed; a document's
runs are joined to those of the benchmark by hash. Runs that lie on one diagonal (equal
distance between place in the document and place in the item) make one alignment, whose
slots, the values behind the placeholders, have to be consistent: a value of the item
always stands for the same value of the document. Runs with the item's own values need no
such check.

A title-case word that opens a sentence may be a name or not. Runs with such words that the
benchmark never writes in lower case are hashed in both readings, all of them as literals or
all as names, in items and documents alike.

An alignment counts when it has ``need`` runs, or all but one of the item's runs where those
are fewer.
The defaults ask for 6 runs of 8 tokens, 13 tokens in all. Items of fewer than ``width``
tokens are one run of their own length; items of fewer than ``least`` tokens say too little
and match nothing. A run of a template needs a literal token in every second place at least.
With ``exact``, runs that have fewer are joined by a hash of their own values, so that items
of numbers and names are found as they are; ``item_runs`` then counts all runs.

Before the join, documents drop runs whose hash is not in a bitmap of the benchmark's
hashes. This bitmap has a fixed size of ``FILTER_BITS`` bits whatever the benchmark; it only
lets through more when the benchmark is large. The bitmap of the benchmark's lower-case words
decides what is a name, so it grows with them: ``ROOM`` bits a word at least, by which a name
is taken for a word by chance once in ``ROOM`` times. A name that the benchmark also writes in
lower case (mark, rose) is a literal, and copies that change it are missed around it; a larger
benchmark has more of these.

A null or empty text has no runs. A null id is an id like any other. Rows that repeat id
and text are one document. An empty benchmark matches nothing.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch, mix64, slices, to_signed
from tarnwork.llm.substring import window_hashes

FILTER_BITS = 1 << 24
#: Bits per lower-case word of the benchmark, at least.
ROOM = 256
#: Words whose template token a worker remembers.
REMEMBERED = 200_000

_LITERAL, _NUMBER, _UNIT, _NAME, _AMOUNT, _NOTHING = range(6)
#: Template tokens of the placeholders.
_MARKS = mix64(np.arange(1, 7, dtype=np.uint64))

_NAME_PARTS = re.compile(r"['\u2019-]")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_IS_NUMBER = re.compile(r"\d[\d.,:/]*(?:st|nd|rd|th|%)?$")
_IS_AMOUNT = re.compile(r"\d[\d.,]*([^\W\d_]{1,6})$")
_ENDS = re.compile(r"[.!?][\"')\]]*$")
#: Unit words and signs.
_UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ml cl l s sec secs second "
    "seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years hz khz mhz ghz "
    "w kw v a kb mb gb tb km/h mph c f k percent usd eur gbp dollar dollars euro euros cent cents pound pounds".split()
)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bitmap) - 1)
    return bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 > 0


class Templates:
    """Template tokens of texts; remembers words. ``common`` is a bitmap of words that
    are no names."""

    def __init__(self, common: bytes = b""):
        self.common = np.frombuffer(common, np.uint8)
        self.known: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.values: list[str] = []
        self._room(1 << 12)

    def _room(self, size: int) -> None:
        """Arrays of ``size`` that hold what is known of each word."""
        n = len(self.values)
        made = [np.zeros(size, t) for t in (np.uint8, np.uint64, bool)]
        if n:
            for new, old in zip(made, (self.kinds, self.hashes, self.ends)):
                new[:n] = old[:n]
        self.kinds, self.hashes, self.ends = made

    def _kind(self, word: str) -> tuple[int, str, str]:
        """Kind, core and lower case of a word, by itself."""
        core = word.strip(string.punctuation)
        if not core.isalpha():
            core = _EDGES.sub("", word)
            amount = _IS_AMOUNT.match(core)
            if not core:
                return _NOTHING, core, core
            if _IS_NUMBER.match(core):
                return _NUMBER, core, core.lower()
            if amount and amount[1].lower() in _UNITS:
                return _AMOUNT, core, core.lower()
        low = core.lower()
        if low in _UNITS:
            return _UNIT, core, low
        if low != core and core[0].isupper() and len(core) > 1 and (core[1:].islower() or self._many_capitals(core)):
            return _NAME, core, low
        return _LITERAL, core, low

    @staticmethod
    def _many_capitals(core: str) -> bool:
        """Names as O'Neil, McDonald, Jean-Luc."""
        parts = [p for p in _NAME_PARTS.split(core) if p != "s"]
        return any(c.islower() for c in core) and all(p.isalpha() and p[0].isupper() for p in parts)

    def _add(self, words: list[str]) -> None:
        n, to = len(self.values), len(self.values) + len(words)
        if to > len(self.kinds):
            self._room(1 << (to - 1).bit_length())
        kinds, cores, lows = zip(*map(self._kind, words))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(low.encode("utf-8", "surrogatepass"), 5) for low in lows], np.uint64)
        kinds = np.array(kinds, np.uint8)
        if len(self.common):
            kinds[(kinds == _NAME) & _in_bitmap(self.common, hashes)] = _LITERAL
        self.known.update(zip(words, range(n, n + len(words))))
        self.values.extend(cores)
        self.kinds[n:to], self.hashes[n:to] = kinds, hashes
        self.ends[n:to] = [not w[-1].isalnum() and _ENDS.search(w) is not None for w in words]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts one after another: template tokens, whether each is a literal, the word
        of each, whether it is a literal that may be a name as it opens a sentence, and the
        number of its text. Words are looked up once, however often they occur."""
        if len(self.values) > REMEMBERED:
            self._clear()
        # Arrow's white space is that of str.split; at the edges of a text it leaves empty words.
        lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if missing := [w for w in words if w and w not in self.known]:
            self._add(missing)
        at = np.array([self.known.get(w, -1) for w in words], np.int64)[coded.indices.to_numpy()]
        text = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())[at >= 0]
        at = at[at >= 0]
        kinds, hashes, ends = self.kinds, self.hashes, self.ends
        kind, first = kinds[at], np.ones(len(at), bool)
        first[1:] = ends[at[:-1]] | (text[1:] != text[:-1])
        kept = kind != _NOTHING
        at, kind, first, text = at[kept], kind[kept], first[kept], text[kept]
        opening = (kind == _NAME) & first
        kind = np.where(opening, _LITERAL, kind)
        after_number = np.zeros(len(at), bool)
        after_number[1:] = (kind[:-1] == _NUMBER) & (text[1:] == text[:-1])
        kind = np.where((kind == _UNIT) & ~after_number, _LITERAL, kind)
        return np.where(kind == _LITERAL, hashes[at], _MARKS[kind]), kind == _LITERAL, at, opening, text

    def value(self, at: int) -> str:
        return self.values[at]


#: Readings of a run: a template, one whose opening words are names, the values themselves.
_TEMPLATE, _NAMED, _VALUES = range(3)


def _sums(flags: np.ndarray, width: int) -> np.ndarray:
    """How many of every ``width`` flags are set."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[width:] - sums[:-width]


def _runs(templates: Templates, texts: pa.Array, widths: list[int] | None, width: int, least: int, exact: set[int]) -> Iterator[tuple]:
    """``(width, runs, starts, hashes, text, slot, at, reading)`` per width and reading: runs of
    the template in each text, places in all texts of the usable runs with their hashes, and for
    each place its text, whether it is a slot, and its word. Without ``widths`` a text of
    ``least`` tokens is taken at ``width`` or its own length. ``exact`` has the widths at which
    runs of too few literals are taken by their values."""
    tokens, literal, at, opening, text = templates.of(texts)
    counts = np.bincount(text, minlength=len(texts))
    own = np.where(counts >= least, np.minimum(width, counts), 0)
    mixed = mix64(tokens)
    named, fewer = mix64(np.where(opening, _MARKS[_NAME], tokens)), literal & ~opening
    values = mix64(templates.hashes[at] ^ _MARKS[0]) if exact else None
    for size in widths if widths is not None else np.unique(own[own > 0]).tolist():
        if len(tokens) < size:
            continue
        inside = text[size - 1 :] == text[: len(text) - size + 1]
        if widths is None:
            inside &= own[text[: len(inside)]] == size
        hashed = lambda x, starts: mix64(window_hashes(x, size)[starts] ^ np.uint64(size))  # noqa: E731, B023
        enough = 2 * _sums(literal, size) >= size
        starts = np.flatnonzero(inside & enough)
        total = np.bincount(text[starts], minlength=len(texts))
        yield size, total, starts, hashed(mixed, starts), text, ~literal, at, _TEMPLATE
        if opening.any():
            either = np.flatnonzero(inside & (2 * _sums(fewer, size) >= size) & (_sums(opening, size) > 0))
            yield size, total, either, hashed(named, either), text, ~fewer, at, _NAMED
        if size in exact and len(starts := np.flatnonzero(inside & ~enough)):
            yield size, total, starts, hashed(values, starts), text, np.zeros(len(text), bool), at, _VALUES


_RUNS = "h long, id long, tie long, pos long, runs long, every long, width int, reading int, slots array<string>"


def _lower_words(items: DataFrame) -> DataFrame:
    """Hashes of the words that ``items (text)`` have in lower case."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in frames:
            for part in slices(batch):
                templates.of(part.column("text"))
                low = [i for i, v in enumerate(templates.values) if v and v == v.lower()]
                yield pa.RecordBatch.from_arrays([pa.array(to_signed(templates.hashes[low]))], names=["h"])
                templates._clear()

    return items.select("text").mapInArrow(run, "h long")


def _run_table(
    docs: DataFrame,
    widths: list[int] | None,
    width: int,
    least: int,
    common: bytes,
    bits: bytes | None,
    exact: set[int],
) -> DataFrame:
    """Runs of every row of ``docs (id, tie, text)``. Without ``widths`` each text is an
    item. ``widths`` and ``exact`` as in ``_runs``. Texts are taken some hundreds at a time, as
    arrays of all their tokens."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(common)
        filtered = None if bits is None else np.frombuffer(bits, np.uint8)
        for part in (p for batch in frames for p in slices(batch)):
            for size, total, starts, found, text, slot, at, reading in _runs(
                templates, part.column("text"), widths, width, least, exact
            ):
                if filtered is not None:
                    held = _in_bitmap(filtered, found)
                    starts, found = starts[held], found[held]
                if not len(starts):
                    continue
                row = text[starts]
                first, counts = np.searchsorted(text, row), np.bincount(text, minlength=part.num_rows)
                every = counts[row] - size + 1 if size in exact else total[row]
                slots = [[templates.value(at[p + k]) for k in np.flatnonzero(slot[p : p + size]).tolist()] for p in starts.tolist()]
                longs = [to_signed(found), *(part.column(c).take(pa.array(row)) for c in ("id", "tie")), starts - first, total[row], every]
                ints = [pa.array(np.full(len(row), x, np.int32)) for x in (size, reading)]
                columns = [*(pa.array(x) for x in longs), *ints, pa.array(slots, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "id", "tie", "pos", "runs", "every", "width", "reading", "slots"])

    return docs.mapInArrow(run, _RUNS)


def _bitmap(runs: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """The hashes of ``runs (h)`` as a bitmap of ``bits`` bits, made where they are."""
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = (
        runs.select(F.shiftright(place, 5).alias("word"), F.expr("shiftleft(1L, cast(h & 31 AS int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    made = np.zeros(bits >> 5, "<u4")
    for row in words.toLocalIterator():
        made[row["word"]] = row["bits"]
    return made.tobytes()


def _word_bits(words: int) -> int:
    """A power of two with ``ROOM`` bits a word or more."""
    return max(FILTER_BITS, 1 << (max(1, ROOM * words) - 1).bit_length())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    spark: SparkSession,
    width: int = 8,
    need: int = 6,
    least: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    exact: bool = False,
) -> DataFrame:
    """A row per document and item that match: ``(id, tie, item_id, kind, runs, item_runs,
    start, slots)``. ``tie`` is the text's hash, ``kind`` is ``verbatim`` or ``reparameterised``, ``runs``
    counts the item's runs found on the best alignment, ``start`` is its first token in
    the document, ``slots`` maps item values to document values."""
    scratch = Scratch(spark, "decontaminate")

    def picked(df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))

    items = picked(benchmark, item_column, item_text_column)
    lower = scratch.save(_lower_words(items).distinct(), "lower")
    common = _bitmap(lower, _word_bits(lower.count()))
    asked = _run_table(items, None, width, least, common, None, set(range(least, width + 1)) if exact else set())
    asked = scratch.save(asked.drop("tie").dropDuplicates(["h", "id", "pos"]), "items")
    bitmap = _bitmap(asked)
    # ``width`` and shorter lengths that an item has: a few numbers at most.
    had = {(r["width"], r["reading"]) for r in asked.select("width", "reading").distinct().collect()}
    widths, by_value = sorted({w for w, _ in had}), {w for w, reading in had if reading == _VALUES}
    found = _run_table(picked(docs, id_column, text_column), widths, width, least, common, bitmap, by_value)
    found = scratch.save(found.select("h", "id", "tie", "pos", "reading", "slots"), "found")
    item = asked.select(
        "h", F.col("id").alias("item_id"), F.col("pos").alias("at"), F.col("runs").alias("item_templates"),
        F.col("every").alias("item_runs"), F.col("slots").alias("item_slots"),
    )
    matched = found.join(item, "h").where(F.size("slots") == F.size("item_slots"))
    # An opening word is a slot only where the run does not match with it as a literal.
    zipped = F.struct("at", F.arrays_zip("item_slots", "slots").alias("slots"))
    plain = F.collect_set(F.when(F.col("reading") == _TEMPLATE, F.col("at")))
    opened = F.filter(F.collect_list(F.when(F.col("reading") == _NAMED, zipped)), lambda x: ~F.array_contains(plain, x["at"]))
    others = F.collect_list(F.when(F.col("reading") != _NAMED, zipped))
    pairs = F.array_distinct(F.flatten(F.transform(F.concat(others, opened), lambda x: x["slots"])))
    enough, enough_exact = (
        F.least(F.lit(need), F.greatest(F.lit(1), F.col(n) - 1)) for n in ("item_templates", "item_runs")
    )
    template, own = F.col("reading") != _VALUES, F.col("slots") == F.col("item_slots")
    at_of = lambda holds: F.size(F.collect_set(F.when(holds, F.col("at"))))
    same = (F.col("exact") >= enough_exact) | (F.col("exact_templates") >= enough)
    aligned = (
        matched.groupBy(
            "id", "tie", "item_id", "item_templates", "item_runs", (F.col("pos") - F.col("at")).alias("diagonal")
        )
        .agg(
            F.size(F.collect_set("at")).alias("runs"),
            at_of(template).alias("templates"),
            at_of(own).alias("exact"),
            at_of(template & own).alias("exact_templates"),
            F.min("pos").alias("start"),
            pairs.alias("slots"),
        )
        .where((F.col("templates") >= enough) | same)
    )
    keys = F.transform("slots", lambda s: s["item_slots"])
    consistent = aligned.where(same | (F.size("slots") == F.size(F.array_distinct(keys))))
    named = F.transform("slots", lambda s: F.struct(s["item_slots"].alias("item"), s["slots"].alias("document")))
    kind = F.when(same, "verbatim").otherwise("reparameterised")
    return (
        consistent.withColumns({"kind": kind, "slots": named})
        .groupBy("id", "tie", "item_id", "item_runs")
        .agg(F.max_by(F.struct("kind", "runs", "start", "slots"), F.struct("runs", -F.col("diagonal"))).alias("best"))
        .select("id", "tie", "item_id", "best.kind", "best.runs", "item_runs", "best.start", "best.slots")
    )


def without_contaminated(
    docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without the documents that match an item."""
    bad = found.select(F.col("id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    same = docs[id_column].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_column]) == F.col("__tie"))
    return docs.join(bad, same, "left_anti")
