"""Near-duplicate groups by SimHash with bit-sliced comparison.

A fingerprint has one bit per hash bit: set when more than half of the text's word
shingles have it set. Equal fingerprints are one node. Nodes become candidates when
they agree on all bits of a band:

* *exact bands* (``exact_bands``): ``radius + 2`` blocks, two of which must agree if at
  most ``radius`` bits differ, so that no link is lost. A bucket that grows beyond
  ``BUCKET`` nodes is cut again by the same rule over its remaining bits. After three
  rounds few bits are left, so a bucket can no longer hold more than 2^14 nodes.
* *sampled bands* (``sampled_bands``): runs of bits for wide radii, where blocks would
  be too short. Buckets beyond ``BUCKET`` nodes are cut into slices and every pair of
  slices is compared, in a task of its own.

Within a bucket the distances are counted bit-sliced: the planes hold one bit of 64
nodes per word, a carry-save adder counts the differing bits of 64 pairs at once, and
words in which all pairs exceed the radius are abandoned. A task reports a spanning
forest of the links it finds, at most one edge per node, never all pairs.

``near_groups`` takes such links as candidates only: the distinct texts that hang together
over them are compared by their exact sets of shingles, and only pairs of the asked
similarity are linked. A large set of candidates is cut into slices, and every two slices
are compared in a task of their own.

Nulls: a null text is an empty one; a text without words has fingerprint zero. A null
id is kept, but never names a group. Repeated rows share a fingerprint and so a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch, mix64, slices, texts_of, to_signed, to_unsigned
from tarnwork.llm.components import connected

#: Nodes in a bucket beyond which it is cut further.
BUCKET = 4096
#: Nodes compared at a time; several buckets are taken together.
CHUNK = 32768
#: Shingles hashed at a time, which bounds the memory a long text takes.
PART = 1 << 16
#: Texts and shingles of a slice of candidates.
SLICE, SLICE_SHINGLES = 512, 1 << 21


@dataclass(frozen=True)
class Bands:
    """Masks over a fingerprint's lanes. ``children`` says how a bucket is cut again."""

    masks: tuple[tuple[int, ...], ...]
    exact: bool


def _lanes(bits: list[int], lanes: int) -> tuple[int, ...]:
    return tuple(sum(1 << (b % 64) for b in bits if b // 64 == lane) for lane in range(lanes))


def _choose(bits: list[int], radius: int) -> list[list[int]]:
    blocks = [list(x) for x in np.array_split(np.array(bits), radius + 2)]
    return [[int(b) for b in a + c] for a, c in combinations(blocks, 2)]


def exact_bands(radius: int = 3, given: tuple[int, ...] = (0,)) -> Bands:
    """Bands for 64 bits that lose no pair within ``radius``; ``given`` are bits that
    are known to agree."""
    left = [b for b in range(64) if not given[0] >> b & 1]
    return Bands(
        tuple((_lanes(part, 1)[0] | given[0],) for part in _choose(left, radius)), exact=True
    )


def sampled_bands(bits: int, width: int, count: int) -> Bands:
    """``count`` bands of ``width`` bits spread over a fingerprint of ``bits`` bits."""
    order = np.random.default_rng(7).permutation(np.tile(np.arange(bits), -(-count * width // bits)))
    masks = []
    for i in range(count):
        masks.append(_lanes([int(b) for b in set(order[i * width : (i + 1) * width].tolist())], bits // 64))
    return Bands(tuple(masks), exact=False)


def _shingles(tokens: list[bytes], words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, ``PART`` at a time."""
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    first, last = starts[:n], ends[min(words, len(ends)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, PART):
        a, b = first[at : at + PART].tolist(), last[at : at + PART].tolist()
        yield np.array([digest(line[i:j], seed) for i, j in zip(a, b)], np.uint64)


def fingerprint(text: bytes | None, words: int, lanes: int, seed: int = 42) -> np.ndarray:
    """The fingerprint of one text as ``lanes`` unsigned 64-bit integers. Further lanes
    come from the shingle's hash by a one-to-one mixing."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(lanes, np.uint64)
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros((lanes, 64), np.int64)
    for h in _shingles(tokens, words, seed):
        for lane in range(lanes):
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[lane] += bits.sum(axis=0, dtype=np.int32)
            h = mix64(h)
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_set(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """The distinct shingle hashes of one text, sorted."""
    tokens = (text or b"").lower().split()
    return np.unique(np.concatenate([*_shingles(tokens, words, seed)])) if tokens else np.zeros(0, np.uint64)


def _identity(text: bytes | None) -> tuple[int, int]:
    """128 bits of the words of a text, as two longs."""
    digest = xxhash.xxh128_digest(b" ".join((text or b"").lower().split()))
    return tuple(np.frombuffer(digest, np.int64).tolist())


def fingerprints(
    docs: DataFrame, words: int, lanes: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, fp)`` per row, ``fp`` an array of ``lanes`` longs."""
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            made = [fingerprint(t, words, lanes) for part in slices(batch) for t in texts_of(part, "text")]
            flat = to_signed(np.concatenate(made)) if made else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(len(made) + 1, dtype=np.int32) * lanes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                names=["id", "fp"],
            )

    return picked.mapInArrow(run, "id long, fp array<long>")


def _matrix(batch: pa.RecordBatch, lanes: int) -> np.ndarray:
    return to_unsigned(batch.column("fp").flatten()).reshape(-1, lanes)


def _keys(fps: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """A bucket number from the masked bits. Buckets that happen to share a number are
    compared together, which costs time but changes nothing."""
    key = np.full(len(fps), (salt * 0x9E3779B97F4A7C15) & (2**64 - 1), np.uint64)
    for lane, m in enumerate(mask):
        key = mix64(key ^ (fps[:, lane] & np.uint64(m)))
    return key


_BANDED = "node long, fp array<long>, band long, key long"


def _banded(nodes: DataFrame, bands: Bands, lanes: int) -> DataFrame:
    """A row per node and band. With a ``band`` column the node is cut again inside
    that band: its number is the path of choices, read in base ``len(masks)``."""
    deeper, count = "band" in nodes.columns, len(bands.masks)

    def emit(node, fps, mask, number):
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(len(fps) + 1, dtype=np.int32) * lanes), pa.array(to_signed(fps.ravel()))
        )
        key = pa.array(to_signed(_keys(fps, mask, number)))
        return pa.RecordBatch.from_arrays(
            [node, flat, pa.array(np.full(len(fps), number, np.int64)), key],
            names=["node", "fp", "band", "key"],
        )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            fps = _matrix(batch, lanes)
            if not deeper:
                for number, mask in enumerate(bands.masks, 1):
                    yield emit(batch.column("node"), fps, mask, number)
                continue
            paths = batch.column("band").to_numpy()
            for path in np.unique(paths):
                here = np.flatnonzero(paths == path)
                inner = exact_bands(_radius_of(count), _mask_of(int(path), bands))
                for number, mask in enumerate(inner.masks, 1):
                    yield emit(
                        batch.column("node").take(pa.array(here)), fps[here], mask, int(path) * (count + 1) + number
                    )

    return nodes.mapInArrow(run, _BANDED)


def _radius_of(count: int) -> int:
    """``radius + 2`` blocks make ``count`` pairs."""
    blocks = 2
    while blocks * (blocks - 1) // 2 < count:
        blocks += 1
    return blocks - 2


def _mask_of(path: int, bands: Bands) -> tuple[int, ...]:
    count, steps = len(bands.masks), []
    while path:
        path, step = divmod(path, count + 1)
        steps.append(step - 1)
    mask = (0,)
    for step in reversed(steps):
        mask = exact_bands(_radius_of(count), mask).masks[step]
    return mask


def _add(counter: list[np.ndarray], over: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Add eight planes of differing bits to the vertical counter, carry-save. Returns
    ``over`` with the lanes whose count has run over."""

    def full(a, b, c):
        half = a ^ b
        return half ^ c, (a & b) | (half & c)

    s1, t1 = full(planes[0], planes[1], planes[2])
    s2, t2 = full(planes[3], planes[4], planes[5])
    s3, t3 = full(s1, s2, planes[6])
    counter[0], t4 = full(s3, planes[7], counter[0])
    u1, f1 = full(t1, t2, t3)
    counter[1], f2 = full(u1, t4, counter[1])
    if len(counter) == 2:
        return over | f1 | f2
    counter[2], carry = full(f1, f2, counter[2])
    for j in range(3, len(counter)):
        counter[j], carry = counter[j] ^ carry, counter[j] & carry
    return over | carry


def bit_sliced_links(fps: np.ndarray, buckets: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``(i, j)`` of all pairs of one bucket at distance ``radius`` or less.
    ``buckets`` has equal numbers side by side, larger buckets first."""
    n, bits = len(fps), fps.shape[1] * 64
    words = -(-n // 64)
    flat = np.zeros(((words + 1) * 64, fps.shape[1]), np.uint64)
    flat[:n] = fps
    rows = np.unpackbits(flat.view(np.uint8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(rows.T), axis=1, bitorder="little").view(np.uint64)
    del rows, flat
    edge = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
    sizes = np.diff(np.concatenate((edge, [n])))
    after = np.repeat(edge + sizes, sizes) - np.arange(n) - 1  # rows of the bucket still to come
    width = max(2, int(radius).bit_length())
    start = (1 << width) - 1 - radius
    for d in range(1, int(sizes.max(initial=1))):
        reach = int(sizes[sizes > d].sum())
        live_words = -(-reach // 64)
        valid = np.zeros(live_words * 64, np.uint8)
        valid[:reach] = after[:reach] >= d
        over = ~np.packbits(valid, bitorder="little").view(np.uint64)
        live = np.flatnonzero(~over)
        over = over[live]
        whole, part = d >> 6, np.uint64(d & 63)
        counter = [np.full(len(live), (2**64 - 1) * (start >> j & 1), np.uint64) for j in range(width)]
        for g in range(0, bits, 8):
            own = planes[g : g + 8, live]
            other = planes[g : g + 8, np.minimum(live + whole, words)]
            if part:
                beyond = planes[g : g + 8, np.minimum(live + whole + 1, words)]
                other = (other >> part) | (beyond << (np.uint64(64) - part))
            over = _add(counter, over, own ^ other)
            stay = over != np.uint64(2**64 - 1)
            if not stay.all():
                live, over = live[stay], over[stay]
                counter = [c[stay] for c in counter]
            if not len(live):
                break
        if len(live):
            found = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(found)
            at = live[word] * 64 + lane
            yield at, at + d


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position that each position is linked to, over any number of links."""
    root = np.arange(n)
    for i, j in links:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            continue
        for x, y in np.unique(np.stack((a[apart], b[apart]), 1), axis=0).tolist():
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    return root


def _compare(rows: DataFrame, lanes: int, radius: int) -> DataFrame:
    """Edges of a spanning forest per bucket; buckets are whole in their partition."""

    def flush(node, fps, key):
        _, which, sizes = np.unique(key, return_inverse=True, return_counts=True)
        keep = sizes[which] > 1
        node, fps, which = node[keep], fps[keep], which[keep]
        if not len(node):
            return None
        order = np.lexsort((which, -sizes[which]))
        node, fps, which = node[order], fps[order], which[order]
        root = forest(len(node), bit_sliced_links(fps, which, radius))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"]
        )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in frames:
            held.append((batch.column("node").to_numpy(), _matrix(batch, lanes), batch.column("key").to_numpy()))
            count += batch.num_rows
            if count < CHUNK:
                continue
            node, fps, key = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if cut and (out := flush(node[:cut], fps[:cut], key[:cut])) is not None:
                yield out
            held, count = [(node[cut:], fps[cut:], key[cut:])], len(node) - cut
        if count and (out := flush(*(np.concatenate(x) for x in zip(*held)))) is not None:
            yield out

    ready = rows.repartition(F.col("key")).sortWithinPartitions("key")
    return ready.select("node", "fp", "key").mapInArrow(run, "a long, b long")


def _bounded(nodes: DataFrame, bands: Bands, lanes: int, scratch: Scratch) -> DataFrame:
    """A row per node and band, with every bucket within bounds and in reach of one task.
    Rows are made anew for counting; that is cheaper than keeping them."""
    rows, done = _banded(nodes, bands, lanes), []
    for level in range(3):
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET)
        large = scratch.save(large, f"large_buckets{level}")
        if large.isEmpty():
            break
        if not bands.exact:
            joined = rows.join(large, "key", "left")
            small = joined.where(F.col("n").isNull()).select(*rows.columns)
            slices = F.ceil(F.col("n") / (BUCKET // 2))
            own = F.pmod(F.xxhash64("node"), slices)
            cut = (
                joined.where(F.col("n").isNotNull())
                .withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), slices - 1))})
                .where(F.col("own") != F.col("other"))
                .withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
            )
            return small.unionByName(cut.select(*rows.columns))
        done.append(rows.join(large, "key", "left_anti").select("node", "fp", "band", "key"))
        rows = rows.join(large, "key", "left_semi").select("node", "fp", "band", "key")
        if level < 2:  # after three rounds 14 bits are left: 2^14 nodes in a bucket at most
            rows = scratch.save(_banded(rows.select("node", "fp", "band"), bands, lanes), f"bands{level}")
    return _union([*done, rows])


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def groups(
    docs: DataFrame,
    spark: SparkSession,
    words: int = 3,
    radius: int = 3,
    lanes: int = 1,
    bands: Bands | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, fp, component_id)`` per row of ``docs``: the smallest id of the rows that
    can be reached over links of ``radius`` or fewer differing bits."""
    if bands is None:
        if lanes != 1:
            raise ValueError("several lanes need sampled bands")
        bands = exact_bands(radius)
    scratch = Scratch(spark, "simhash")
    made = scratch.save(fingerprints(docs, words, lanes, id_column, text_column), "fingerprints")
    rooted = _rooted(made, bands, lanes, radius, scratch)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = scratch.save(rooted.join(named, "root").select("fp", "component_id"), "labels")
    return made.join(labels, "fp").select("id", "fp", "component_id")


def _rooted(made: DataFrame, bands: Bands, lanes: int, radius: int, scratch: Scratch) -> DataFrame:
    """``(fp, least, node, root)`` per fingerprint of ``made (id, fp)``, ``root`` being the
    smallest node that links of ``radius`` or fewer bits lead to."""
    nodes = made.groupBy("fp").agg(F.min("id").alias("least"))
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = _bounded(nodes.select("node", "fp"), bands, lanes, scratch)
    edges = scratch.save(_compare(rows, lanes, radius), "links")
    scratch.drop(*(f"{x}{i}" for x in ("bands", "large_buckets") for i in range(3)))
    roots = connected(edges, scratch)
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _text_rows(docs: DataFrame, words: int, lanes: int, id_column: str, text_column: str) -> DataFrame:
    """``(id, raw, t1, t2, size, fp)`` per row: hash of the text, identity of its words,
    shingles with repeats, fingerprint."""
    picked = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("raw"), F.col(text_column).alias("text")
    )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            texts = texts_of(batch, "text")
            named = np.array([_identity(t) for t in texts], np.int64).reshape(-1, 2)
            flat = [x for t in texts for x in to_signed(fingerprint(t, words, lanes)).tolist()]
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * lanes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("raw"), pa.array(named[:, 0]), pa.array(named[:, 1]),
                    pa.array([len((t or b"").split()) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
                ],
                names=["id", "raw", "t1", "t2", "size", "fp"],
            )

    return picked.mapInArrow(run, "id long, raw long, t1 long, t2 long, size long, fp array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``(t1, t2, shingles)`` per row of ``docs (text)``."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for text in texts_of(batch, "text"):
                t1, t2 = _identity(text)
                held = pa.array([to_signed(shingle_set(text, words)).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t1], pa.int64()), pa.array([t2], pa.int64()), held], names=["t1", "t2", "shingles"]
                )

    return docs.mapInArrow(run, "t1 long, t2 long, shingles binary")


def similar_links(sets: list[np.ndarray], sides: list[int], whole: bool, similarity: float) -> np.ndarray:
    """Smallest position each set is linked to, over all pairs of ``similarity`` or more.
    Unless ``whole``, pairs of one side are left to another task. Pairs that hang
    together already are not compared again."""
    sizes = np.array([len(x) for x in sets])
    root = np.arange(len(sets))
    side = np.array(sides)
    for i in range(len(sets)):
        small, large = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
        near = small + 1e-9 >= similarity * large
        if not whole:
            near &= side[i + 1 :] != side[i]
        for j in (np.flatnonzero(near) + i + 1).tolist():
            if root[i] == root[j]:
                continue
            both = np.concatenate((sets[i], sets[j]))
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            if shared * (1 + similarity) + 1e-9 >= similarity * (sizes[i] + sizes[j]):
                a, b = sorted((root[i], root[j]))
                root[root == b] = a
    return root


def _verified(pieces: DataFrame, similarity: float) -> DataFrame:
    """Edges between texts of ``pieces (key, whole, own, node, shingles)``; a key is whole in
    its partition and the only thing held."""

    def close(held: list[dict]) -> pa.RecordBatch:
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in held]
        root = similar_links(sets, [r["own"] for r in held], held[0]["whole"], similarity)
        moved = np.flatnonzero(root != np.arange(len(root)))
        node = np.array([r["node"] for r in held], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in frames:
            for row in batch.to_pylist():
                if held and (held[0]["root"], held[0]["low"], held[0]["high"]) != (row["root"], row["low"], row["high"]):
                    yield close(held)
                    held = []
                held.append(row)
        if held:
            yield close(held)

    by = ["root", "low", "high"]
    return pieces.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


def near_rows(
    docs: DataFrame,
    spark: SparkSession,
    words: int,
    radius: int,
    lanes: int,
    bands: Bands,
    similarity: float,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, raw, root)`` per row of ``docs``: rows whose sets of shingles can be reached over
    links of ``similarity`` or more share ``root``. ``raw`` is the hash of the text. Links
    are looked for among texts that hang together within ``radius`` bits. Texts are told
    apart by 128 bits of their words; one row stands for all copies of a text, so copies do
    not meet when texts are looked up."""
    scratch = Scratch(spark, "near")
    made = scratch.save(_text_rows(docs, words, lanes, id_column, text_column), "texts")
    loose = _rooted(made, bands, lanes, radius, scratch).select("fp", F.col("root").alias("loose"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "raw")).alias("first")
    texts = made.groupBy("t1", "t2", "fp").agg(first, F.max("size").alias("size"))
    texts = texts.join(loose, "fp").select("t1", "t2", F.col("first.id").alias("of"), F.col("first.raw").alias("raw"), "size", "loose")
    texts = scratch.save(texts.withColumn("node", F.monotonically_increasing_id()), "candidates")
    many = texts.groupBy("loose").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).where(F.col("n") > 1)
    asked = scratch.save(texts.join(many, "loose"), "asked")
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("hashed"), F.col(text_column).alias("text"))
    one = (F.col("hashed") == F.col("raw")) & F.col("id").eqNullSafe(F.col("of"))
    sets = _sets(picked.join(asked.select("of", "raw"), one, "left_semi").select("text"), words)
    slices = F.greatest(F.ceil(F.col("n") / SLICE), F.ceil(F.col("total") / SLICE_SHINGLES))
    own = F.pmod(F.xxhash64("node"), slices)
    held = asked.join(scratch.save(sets.dropDuplicates(["t1", "t2"]), "sets"), ["t1", "t2"])
    pieces = held.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), slices - 1))}).select(
        F.col("loose").alias("root"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") == F.col("other")).alias("whole"), "own", "node", "shingles",
    )
    edges = scratch.save(_verified(pieces, similarity), "similar")
    roots = connected(edges, Scratch(spark, "near_stars"))
    labels = texts.join(roots, "node", "left").select("t1", "t2", F.coalesce("root", "node").alias("root"))
    return scratch.save(made.join(labels, ["t1", "t2"]).select("id", "raw", "root"), "rows")


def near_groups(docs: DataFrame, spark: SparkSession, *args, **options) -> DataFrame:
    """The rows of ``near_rows``, which takes the same arguments, with ``component_id``, the
    smallest id of their root."""
    rows = near_rows(docs, spark, *args, **options)
    return rows.join(rows.groupBy("root").agg(F.min("id").alias("component_id")), "root")


def hex_of(fp: str = "fp", lane: int = 0):
    return F.lower(F.lpad(F.hex(F.col(fp)[lane]), 16, "0"))


def survivors(docs: DataFrame, grouped: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of ``grouped (id, raw, root)``: the smallest id, of equal ids and
    among rows without id the smallest hash of the text. Texts under one id are told apart.
    Groups are reduced before their shuffle if ``grouped`` is not yet dealt by root, as the
    written rows of ``near_rows`` are not."""
    order = F.struct(F.col("id").isNull(), "id", "raw")
    best = grouped.groupBy("root").agg(F.min(order).alias("best")).select("best.id", "best.raw").distinct()
    best = best.select(F.col("id").alias("__id"), F.col("raw").alias("__raw"))
    hashed = docs.withColumn("__text", F.xxhash64(text_column))
    same = (hashed["__text"] == best["__raw"]) & hashed[id_column].eqNullSafe(best["__id"])
    return hashed.join(best, same, "left_semi").dropDuplicates([id_column, "__text"]).drop("__text")


def first_of_group(docs: DataFrame, grouped: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The document that names its group, for each group. Rows without an id stay;
    rows that repeat an id are one document."""
    kept = grouped.where(F.col("id") == F.col("component_id")).select(F.col("id").alias("__id")).distinct()
    named = docs.join(kept, docs[id_column] == F.col("__id"), "left_semi").dropDuplicates([id_column])
    return named.unionByName(docs.where(F.col(id_column).isNull()))
