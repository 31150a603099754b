"""What the operators share: scratch tables, words, Arrow columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.sources.storage import qualified, scratch_dir

#: A word, as SQL text: a run of anything but the six ASCII white-space characters.
WORD = "[^\\x20\\x09-\\x0D]+"

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


class Scratch:
    """Tables under the shared folder, which every executor can read again after a
    loss. A written table also cuts the lineage of what is built on it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.dir = spark, qualified(spark, scratch_dir(spark, name))

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(id_column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit integers, one to one."""
    x = x + _MIX[2]
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as bytes, without decoding it."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, name: str = "text", rows: int = 512, room: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with ``rows`` rows at most and ``room`` bytes in column ``name``, or one
    row if that alone is longer. What is made of a part goes before the next is taken."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + room, side="right"))
        to = min(batch.num_rows, at + rows, max(at + 1, full))
        yield batch.slice(at, to - at)
        at = to


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Pack row tuples into Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield to_batch(schema, held)
            held = []
    if held:
        yield to_batch(schema, held)


def to_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def to_signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def to_unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def vote(table: pa.Table, read, decide) -> pa.Table:
    """Answer every row of a slice with one bit per entry of its body: ``read`` turns
    a body into an array, ``decide`` says of all arrays joined, with a flag for entries
    that their sender holds more than once, which entries are held twice or more."""
    bodies = [read(b) for b in table.column("body").to_pylist()]
    sizes = np.array([len(b) for b in bodies], np.int64)
    twice = [bits_of(b, n) for b, n in zip(table.column("twice").to_pylist(), sizes)]
    found = decide(np.concatenate(bodies), np.concatenate(twice))
    bits = [np.packbits(x, bitorder="little").tobytes() for x in np.split(found, np.cumsum(sizes)[:-1])]
    return pa.table(
        {
            "block": table.column("block"),
            "slice": table.column("slice"),
            "n": pa.array(sizes),
            "bits": pa.array(bits, pa.binary()),
        }
    )


def bits_of(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=int(n), bitorder="little").astype(bool)
