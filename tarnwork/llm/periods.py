"""Runs of periodically repeated words, by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``max(least, times * q)`` words that no neighbouring word extends; ``times`` is 3, or more.

Texts are packed into arrays of word numbers, each text closed by a number of its own, so
that nothing matches across texts. Per pack:

1. Suffixes are sorted by doubling. At every depth D = 8, 16, ... the aligned blocks of D
   words know the interval of the suffix array that starts with them. Blocks that occur once
   in the pack go no further.
2. A wavelet tree over the suffix array answers range successors: the next occurrence of a
   block at or after a place. A block at i looks for occurrences in the window from i + D to
   i + 2D - 1, the blocks of 8 words also from i + 1 to i + 8.
3. Occurrences in a window are one arithmetic progression. One or two of them are candidate
   periods themselves. Three or more mean that the block has the difference p as period; then
   the stretches of period p around block and progression are aligned by their right and by
   their left ends, which gives two candidates.
4. Candidates are extended both ways by comparing hashes of prefixes; each stretch found is
   compared word by word, and kept if no divisor of its period is a period.

Nothing is missed: a run of period q, D <= q < 2D, is at least 3q >= 2D + q - 1 long and so
holds an aligned block of D words and its copy q further; periods under 8 have 24 words, which
hold a block of 8 and its copy, and no occurrence lies between. If the block has a smaller
period p and both its stretch and the copy's ended outside the run, the run would have the
period gcd(p, q). So ``times`` may not be under 3, nor ``least`` under 24.

A null text has no words. Rows are independent of each other: rows with equal or no ids are
texts of their own, and extra columns are not read. A pack is 4 MB of text or one text, so
the longest text must fit a worker, at some 100 bytes a word besides the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import mix64, texts_of

#: Bytes of the texts of a pack.
PACK_BYTES = 1 << 22
#: Words of the smallest blocks.
SMALLEST = 8

_BASE = 0x9E3779B97F4A7C15


def blocks(codes: np.ndarray, deepest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """The suffix array, sorted as deep as blocks need it, and per depth up to ``deepest`` the
    aligned blocks that occur more than once: places, depth, ends of their intervals."""
    n = len(codes)
    key = codes * (int(codes.max()) + 2)
    key[:-1] += codes[1:] + 1
    order = np.argsort(key)
    suffixes = order.astype(np.int32)
    rank, end = np.zeros(n, np.int32), np.zeros(n, np.int32)

    def regroup(at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Split groups, which ``at`` lists by place, where the ordered keys differ; returns
        the places of groups that still hold two or more."""
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=len(at))
        starts = at[first]
        rank[suffixes[at]] = np.repeat(starts, sizes)
        end[starts] = starts + sizes
        return at[np.repeat(sizes > 1, sizes)]

    at, depth, found = regroup(np.arange(n), key[order]), 2, []
    while depth < deepest and len(at):
        here = suffixes[at].astype(np.int64)
        after = here + depth
        key = rank[here] * np.int64(n + 1)
        inside = after < n
        key[inside] += rank[after[inside]] + 1
        order = np.argsort(key)
        suffixes[at] = here[order]
        at, depth = regroup(at, key[order]), 2 * depth
        if depth >= SMALLEST:
            place = np.arange(0, n, depth)
            low = rank[place]
            high = end[low]
            many = high - low > 1
            found.append((place[many], np.full(int(many.sum()), depth), low[many], high[many]))
    return suffixes, found


class Wavelets:
    """A wavelet tree over ``values``, all below their number, level by level."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        for bit in reversed(range(max(1, (self.n - 1).bit_length()))):
            ones = (values >> bit) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((bit, words, before, self.n - int(ones.sum())))
            values = np.concatenate((values[~ones], values[ones]))

    def _ones(self, words: np.ndarray, before: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Ones among the first ``to`` bits."""
        at = to >> 6
        mask = (np.uint64(1) << (to & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & mask).astype(np.int64)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of ``values[low:high]`` that is ``least`` or more; where there is
        none, a number beyond all values."""
        out = np.full(len(low), 1 << 62)
        go = np.flatnonzero((least < self.n) & (low < high))
        low, high, least = low[go].astype(np.int64), high[go].astype(np.int64), least[go]
        a, b, smaller = low, high, np.zeros(len(go), np.int64)
        for bit, words, before, zeros in self.levels:
            one_a, one_b = self._ones(words, before, a), self._ones(words, before, b)
            right = (least >> bit) & 1 == 1
            smaller += np.where(right, (b - one_b) - (a - one_a), 0)
            a, b = np.where(right, zeros + one_a, a - one_a), np.where(right, zeros + one_b, b - one_b)
        some = smaller < high - low
        go, a, b, left = go[some], low[some], high[some], smaller[some]
        value = np.zeros(len(go), np.int64)
        for bit, words, before, zeros in self.levels:
            one_a, one_b = self._ones(words, before, a), self._ones(words, before, b)
            count = (b - one_b) - (a - one_a)
            right = left >= count
            left = np.where(right, left - count, left)
            value |= right.astype(np.int64) << bit
            a, b = np.where(right, zeros + one_a, a - one_a), np.where(right, zeros + one_b, b - one_b)
        out[go] = value
        return out


class Prefixes:
    """How far two places of ``codes`` agree, by hashes of prefixes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        powers = np.full(self.n + 1, _BASE, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mix64(codes.astype(np.uint64)) * self.powers[:-1], out=self.sums[1:])

    def _same(self, a: np.ndarray, b: np.ndarray, a2: np.ndarray, b2: np.ndarray) -> np.ndarray:
        return (self.sums[a2] - self.sums[a]) * self.powers[b - a] == self.sums[b2] - self.sums[b]

    def _longest(self, most: np.ndarray, same) -> np.ndarray:
        length = np.zeros(len(most), np.int64)
        for bit in reversed(range(int(most.max(initial=0)).bit_length())):
            tried = length + (1 << bit)
            go = np.flatnonzero(tried <= most)
            length[go] = np.where(same(go, tried[go]), tried[go], length[go])
        return length

    def stretch(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch with ``period`` around ``at`` and ``at + period``."""
        to = at + period
        ahead = self._longest(self.n - to, lambda go, x: self._same(at[go], to[go], at[go] + x, to[go] + x))
        back = self._longest(at, lambda go, x: self._same(at[go] - x, to[go] - x, at[go], to[go]))
        return at - back, to + ahead


def candidates(codes: np.ndarray, longest: int, near: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Places and candidate periods."""
    deepest = SMALLEST
    while 2 * deepest * 3 <= longest:
        deepest *= 2
    suffixes, found = blocks(codes, deepest)
    if not sum(len(f[0]) for f in found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree = Wavelets(suffixes)
    at, depth, low, high = (np.concatenate(x) for x in zip(*found))
    out = []

    small = depth == SMALLEST
    place = at[small]
    step = tree.successor(low[small], high[small], place + 1) - place
    out.append((place[step <= SMALLEST], step[step <= SMALLEST]))

    first = tree.successor(low, high, at + depth)
    go = first < at + 2 * depth
    at, depth, low, high, first = (x[go] for x in (at, depth, low, high, first))
    out.append((at, first - at))
    second = tree.successor(low, high, first + 1)
    go = second < at + 2 * depth
    at, depth, low, high, first, second = (x[go] for x in (at, depth, low, high, first, second))
    out.append((at, second - at))
    third = tree.successor(low, high, second + 1)
    go = third < at + 2 * depth
    at, depth, first, period = at[go], depth[go], first[go], (second - first)[go]
    x, y = near.stretch(at, period)
    x2, y2 = near.stretch(first, period)
    for step in (y2 - y, x2 - x):
        fits = (step >= depth) & (step < 2 * depth)
        out.append((at[fits], step[fits]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _factors(n: int) -> Iterator[int]:
    """The prime factors of a number, each once."""
    p = 2
    while p * p <= n:
        if n % p == 0:
            yield p
            while n % p == 0:
                n //= p
        p += 1
    if n > 1:
        yield n


def _repeats(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    return np.array_equal(codes[start : end - period], codes[start + period : end])


def _compared(codes: np.ndarray, start: int, end: int, period: int, at: int) -> tuple[int, int]:
    """The stretch around ``at``, word by word, for the case that hashes were equal by chance."""
    differ = np.flatnonzero(codes[start : end - period] != codes[start + period : end]) + start
    place = int(np.searchsorted(differ, at))
    low = int(differ[place - 1]) + 1 if place else start
    return low, (int(differ[place]) + period if place < len(differ) else end)


def runs_of(codes: np.ndarray, longest: int, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs, in order. ``longest`` bounds their length."""
    if longest < least:
        return []
    near = Prefixes(codes)
    at, period = candidates(codes, longest, near)
    start, end = near.stretch(at, period)
    long = end - start >= np.maximum(least, times * period)
    found: dict[tuple[int, int, int], int] = {}
    for s, e, q, i in zip(*(x[long].tolist() for x in (start, end, period, at))):
        found.setdefault((s, e, q), i)
    out = set()
    for (s, e, q), i in found.items():
        if not _repeats(codes, s, e, q):
            s, e = _compared(codes, s, e, q, i)
        if e - s >= max(least, times * q) and not any(_repeats(codes, s, e, q // f) for f in _factors(q)):
            out.add((s, e, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _pack(texts: list[bytes | None], least: int, times: int) -> Iterator[tuple[int, list[tuple], bytes]]:
    """Per text: number of words, runs, words left after all but a run's first period."""
    words = [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
    known = len(flat.dictionary)
    codes = np.empty(int(sizes.sum()) + len(words), np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    closing = np.zeros(len(codes), bool)
    closing[ends - 1] = True
    codes[~closing] = flat.indices.to_numpy()
    codes[closing] = known + np.arange(len(words))
    per_text: list[list[tuple]] = [[] for _ in words]
    found = runs_of(codes, int(sizes.max(initial=0)), least, times)
    owners = np.searchsorted(ends, [r[0] for r in found], "right").tolist()
    for k, (s, e, q) in zip(owners, found):
        per_text[k].append((s - int(starts[k]), e - s, q))
    for w, runs in zip(words, per_text):
        if runs:
            step = np.zeros(len(w) + 1, np.int64)
            for s, length, q in runs:
                step[s + q] += 1
                step[s + length] -= 1
            kept = [w[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
        else:
            kept = w
        yield len(w), runs, b" ".join(kept)


def periodic(
    docs: DataFrame, least: int = 24, times: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` per row: runs by start and period, and the text of
    words that no run holds after its first period."""
    if least < 24 or times < 3:
        raise ValueError("least must be 24 or more and times 3 or more")
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    run = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def close(ids: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
        counts, runs, left = zip(*_pack(texts, least, times))
        named = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(named, run), pa.array(left, pa.binary()).cast(pa.string())],
            names=["id", "n_words", "runs", "collapsed"],
        )

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            texts, start, size = texts_of(batch, "text"), 0, 0
            for i, text in enumerate(texts):
                n = len(text or b"")
                if i > start and size + n > PACK_BYTES:
                    yield close(batch.column("id").slice(start, i - start), texts[start:i])
                    start, size = i, 0
                size += n
            if start < len(texts):
                yield close(batch.column("id").slice(start), texts[start:])

    kind = picked.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return picked.mapInArrow(work, schema)
