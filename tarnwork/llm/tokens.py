"""Token ids as flat binary files.

A data set is a folder of shards. A shard has

* ``<shard>.ids``  token ids one after another, little-endian unsigned integers of 2
  bytes (vocabularies of up to 65,536 ids) or 4 bytes;
* ``<shard>.off``  64-bit offsets into the whole data set, one per document and one end;
* ``<shard>.doc``  64-bit ids of the documents;

and the table ``shards`` has a row per shard. Documents are in ascending order of id over
the shards, those without id first, rows of equal id by text hash. Each document ends with
``end_id``. A shard's offsets start at its base, the sum of all ids before it: shards are
written first, their bases are prefix sums over the table of shards, and the offsets are
written with the bases added. Only a row per shard is ever gathered for that.

Rows that share an id are spread over shards by their text, so none grows without bound.
Nulls are empty texts. A file belongs to the data set only if its row reached the table,
so the files of failed or repeated task attempts are never read.
"""

from __future__ import annotations

import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm import files
from tarnwork.llm.common import Scratch, slices

#: Pieces whose ids a worker remembers.
REMEMBERED = 600_000
#: Documents encoded together, and bytes of their texts.
TOGETHER, ROOM = 4096, 1 << 22

#: Stands between pieces; a text that holds one is encoded whole.
_CUT = "\0"
#: White space as Python knows it, for Arrow's patterns, whose own class is ASCII only.
_SPACE = "".join(f"\\x{{{ord(c):x}}}" for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
#: A space beside other white space, or the mark; everywhere else a text may be cut before a space.
_TIED = f" [{_SPACE}]|[{_SPACE}] |\\x00"
#: More places where the pre-tokenizer always cuts: after letters before a sign, and around a
#: line feed between two characters that are no white space.
_CUTS = (
    ("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([.,:;!?])", f"\\1{_CUT}\\2"),
    (f"([^{_SPACE}])\n([^{_SPACE}])", f"\\1{_CUT}\n{_CUT}\\2"),
)


class Encoder:
    """Encodes texts with a tokenizer file, remembering the ids of pieces.

    The pre-tokenizer of byte-level vocabularies never joins what stands before a single
    space to what follows it, so a text may be encoded piece by piece: a word with the space
    before it and, after Latin letters, without the signs behind it. Texts in which a space
    touches other white space are encoded whole, as are all texts when the tokenizer is of
    another kind. With ``added``, a text that holds an added token (``<|endoftext|>``) is
    encoded whole too and gets that token's id, as the library does by default; without, such
    a token is text like any other. Pieces not yet known are encoded many at a time, and the
    ids are dealt out to them by their bytes, which the tokens cut up without rest.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.whole = "|".join([_TIED, *map(re.escape, contents)])
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        kind = self.tokenizer.pre_tokenizer
        self.by_word = self.tokenizer.normalizer is None and (
            str(kind).replace(" ", "") == "ByteLevel(add_prefix_space=False,trim_offsets=True,use_regex=True)"
        )
        self.known: dict[str, bytes] = {}
        if self.by_word:
            # A byte-level token has a character per byte.
            self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = (x for i in range(0, len(texts), 64) for x in self.tokenizer.encode_batch_fast(texts[i : i + 64], add_special_tokens=False))
        return [np.array(x.ids, self.dtype).tobytes() for x in made]

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece. Words after a space can stand one after another."""
        alone = [x for x in pieces if x[:1] != " " or x[-1].isspace()]
        found = dict(zip(alone, self._ids(alone)))
        plain = [x for x in pieces if x not in found]
        ends = pc.binary_length(pa.array(plain, pa.string())).to_numpy()
        for at in range(0, len(plain), 512):
            group = plain[at : at + 512]
            made = self.tokenizer.encode_batch_fast(["".join(group)], add_special_tokens=False)
            ids = np.array(made[0].ids, self.dtype)
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(ends[at : at + 512])) + 1
            raw, width = ids.tobytes(), ids.itemsize
            cuts = (cuts * width).tolist()
            found.update(zip(group, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes."""
        raw, sizes = self.joined(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def joined(self, texts: pa.Array, end: bytes = b"") -> tuple[bytes, np.ndarray]:
        """The ids of all texts one after another, each with ``end`` after it, and the bytes of
        each. Arrow cuts the texts and finds their distinct pieces, which alone are looked up."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = pc.match_substring_regex(texts, self.whole) if self.by_word else pc.not_equal(texts, "")
        marked = pc.replace_substring(pc.if_else(whole, "", texts), " ", f"{_CUT} ")
        for pattern, parted in _CUTS:
            marked = pc.replace_substring_regex(marked, pattern, parted)
        cut = pc.split_pattern(marked, _CUT)
        first = cut.offsets.to_numpy()[:-1]
        pieces = cut.flatten().dictionary_encode()
        which, listed = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, listed))
        missing = [i for i, x in enumerate(ids) if x is None]
        fresh = self._pieces([listed[i] for i in missing])
        for i in missing:
            ids[i] = fresh[listed[i]]
        if len(self.known) < REMEMBERED:  # frequent pieces come early and stay
            self.known.update(fresh)
        # Texts that are not cut came as "", one piece: it gets an entry of its own.
        uncut = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        which[first[uncut]] = np.arange(len(uncut)) + len(listed)
        entries = pa.array([*ids, *self._ids(texts.filter(whole).to_pylist()), end], pa.large_binary())
        which = np.insert(which, np.append(first[1:], len(which)), len(entries) - 1)
        taken = entries.take(pa.array(which))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(which) + 1]
        sizes = np.diff(offsets[np.append(first, len(which) - len(first)) + np.arange(len(first) + 1)])
        return taken.buffers()[2].to_pybytes() if offsets[-1] else b"", sizes


def _encoder(path: str, added: bool) -> Encoder:
    """The encoder of this worker, which keeps what it knows from task to task."""
    store = sys.modules.setdefault("_tarnwork_worker", types.ModuleType("_tarnwork_worker"))
    held = store.__dict__.setdefault("encoders", {})
    if (path, added) not in held:
        held[path, added] = Encoder(path, added)
    return held[path, added]


def _forget() -> None:
    """Drop this worker's encoders: with all their words they would stay beside whatever the
    worker does next. What reads the files calls it, as nothing is encoded any more by then."""
    sys.modules.get("_tarnwork_worker", types.SimpleNamespace()).__dict__.pop("encoders", None)


def _ordered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    picked = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).alias("text"),
        F.xxhash64(text_column).alias("tie"),
    )
    parts = max(1, docs.rdd.getNumPartitions())
    return picked.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")


def _write_shards(ordered: DataFrame, folder: str, tokenizer: str, end_id: int, added: bool) -> DataFrame:
    schema = "shard string, width int, docs long, nulls long, ids long, first_id long, first_tie long"

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = None, uuid.uuid4().hex
        for batch in frames:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = _encoder(tokenizer, added)
                end = np.array([end_id], encoder.dtype).tobytes()
                out, lengths, names = files.create(f"{folder}/{shard}.ids"), [], []
                nulls, first = 0, (batch.column("id")[0].as_py(), batch.column("tie")[0].as_py())
            for part in slices(batch, "text", TOGETHER, ROOM):
                raw, sizes = encoder.joined(part.column("text"), end)
                out.write(raw)
                lengths.append(sizes // len(end))
                nulls += part.column("id").null_count
                names.append(part.column("id").fill_null(0).to_numpy())
        if encoder is None:
            return
        out.close()
        counts, ids = np.concatenate(lengths), np.concatenate(names)
        for suffix, values in (("len", counts), ("doc", ids)):
            with files.create(f"{folder}/{shard}.{suffix}") as side:
                side.write(values.astype("<i8").tobytes())
        row = {
            "shard": shard, "width": len(end), "docs": len(ids), "nulls": nulls,
            "ids": int(counts.sum()), "first_id": first[0], "first_tie": first[1],
        }
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row)
        )

    return ordered.mapInArrow(run, schema)


def _write_offsets(shards: DataFrame, folder: str) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        for batch in frames:
            for row in batch.to_pylist():
                lengths = np.frombuffer(files.mapped(f"{folder}/{row['shard']}.len"), "<i8")
                offsets = row["base"] + np.concatenate(([0], np.cumsum(lengths)))
                with files.create(f"{folder}/{row['shard']}.off") as out:
                    out.write(offsets.astype("<i8").tobytes())
            yield batch

    return shards.mapInArrow(run, shards.schema)


def write_tokens(
    docs: DataFrame,
    spark: SparkSession,
    tokenizer: str,
    end_id: int = 0,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    added: bool = False,
) -> str:
    """Write a data set and return its folder, a new one in the shared folder unless one
    is given. ``added`` says whether added tokens in a text get their ids. The tokenizer file must be there on every machine."""
    scratch = Scratch(spark, "tokens")
    folder = folder or scratch.path("set")
    shards = scratch.save(_write_shards(_ordered(docs, id_column, text_column), folder, tokenizer, end_id, added), "written")
    before = Window.orderBy("first_id", "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    count = max(1, shards.count())
    finished = _write_offsets(based.repartition(count), folder)
    finished.write.parquet(f"{folder}/shards")
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, start, n, ids)`` per document from the files: where it starts in the data
    set, how many ids it has with its end, and these as 4-byte little-endian integers."""
    shards = spark.read.parquet(f"{folder}/shards")
    count = max(1, shards.count())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        for batch in frames:
            for row in batch.to_pylist():
                path = f"{folder}/{row['shard']}"
                ids = np.frombuffer(files.mapped(f"{path}.ids"), f"<u{row['width']}")
                starts = np.frombuffer(files.mapped(f"{path}.off"), "<i8")
                names = np.frombuffer(files.mapped(f"{path}.doc"), "<i8")
                missing = np.arange(len(names)) < row["nulls"]
                edges = (starts - row["base"]).tolist()
                for at in range(0, len(names), 512):
                    to = min(at + 512, len(names))
                    own = [ids[a:b].astype("<u4").tobytes() for a, b in zip(edges[at:to], edges[at + 1 : to + 1])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[at:to], mask=missing[at:to]),
                            pa.array(starts[at:to]),
                            pa.array(np.diff(starts[at : to + 1])),
                            pa.array(own, pa.binary()),
                        ],
                        names=["id", "start", "n", "ids"],
                    )

    spread = shards.select("shard", "width", "nulls", "base").repartition(count)
    return spread.mapInArrow(run, "id long, start long, n long, ids binary")
