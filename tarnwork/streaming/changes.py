"""Slowly changing dimensions fed by a stream.

The stored form is a log of reduced changes, one directory per micro-batch. A
repeated batch replaces its own directory, and since type 1 and type 2 are
decided by the sequence column, the order in which batches arrive plays no part.

Every directory is divided into buckets by a hash of the keys; their number is fixed when
the store is made. ``compact_changes`` folds the batches since the last compaction into a
base, one directory per bucket, and rewrites only buckets that these batches touch: a late
change to one key costs one bucket. A manifest, written last, names the directory that holds
each bucket, so readers see a compaction whole or not at all.

    log/batch=<n>/__bucket=<b>/     changes of a micro-batch
    base/upto=<n>/__bucket=<b>/     a bucket as of batch n
    manifest/upto=<n>               which directory holds which bucket
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tarnwork.operators.cdc import reduce_changes, scd1, scd2
from tarnwork.sources.storage import exists, list_names, read_text, remove, write_text

#: Buckets of a new store.
BUCKETS = 64
_BUCKET = "__bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _buckets(spark: SparkSession, path: str, wanted: int | None = None) -> int:
    """Number of buckets of a store; ``wanted``, or the default, for a new one."""
    place = f"{path}/_buckets"
    if not exists(spark, place):
        write_text(spark, place, str(wanted or BUCKETS))
    return int(read_text(spark, place))


def _write(changes: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """One directory per bucket; rows of a bucket are put together first."""
    rows = changes.withColumn(_BUCKET, _bucket(keys, buckets)).repartition(_BUCKET)
    rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(path)


def apply_changes(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: str,
    scd_type: int,
    truncate_when: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Append the available changes to the log at ``path``, reduced per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        count = _buckets(batch.sparkSession, path, buckets)
        reduced = reduce_changes(batch, keys, seq, scd_type, truncate_when)
        _write(reduced, f"{path}/log/batch={batch_id}", keys, count)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    found = [n for n in list_names(spark, path) if n.startswith(prefix)]
    return sorted(int(n.removeprefix(prefix)) for n in found)


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The last batch that has been compacted, -1 for none, and for each bucket of the base
    the compaction that wrote it."""
    done = _numbers(spark, f"{path}/manifest", "upto=")
    if not done:
        return -1, {}
    held = json.loads(read_text(spark, f"{path}/manifest/upto={done[-1]}"))
    return done[-1], {int(b): upto for b, upto in held.items()}


def new_batches(spark: SparkSession, path: str) -> list[int]:
    """Batches that no compaction covers yet. One without its success marker is an error,
    never left out: its changes would be lost in silence."""
    upto, _ = _manifest(spark, path)
    batches = [b for b in _numbers(spark, f"{path}/log", "batch=") if b > upto]
    unfinished = [b for b in batches if not exists(spark, f"{path}/log/batch={b}/_SUCCESS")]
    if unfinished:
        raise RuntimeError(f"batches {unfinished} at {path} have no success marker")
    return batches


def _read(spark: SparkSession, dirs: Sequence[str]) -> DataFrame:
    # Folder names are no columns: a source may have a column of the same name.
    return spark.read.options(mergeSchema=True, recursiveFileLookup=True).parquet(*dirs)


def stored_changes(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> tuple[DataFrame, int]:
    """The base and the batches after it, and the number of the last batch. Before
    anything has been stored, an empty table of ``schema``."""
    upto, base = _manifest(spark, path)
    batches = new_batches(spark, path)
    dirs = [f"{path}/base/upto={u}/{_BUCKET}={b}" for b, u in base.items()]
    dirs += [f"{path}/log/batch={b}" for b in batches]
    if not dirs and schema is not None:
        return spark.createDataFrame([], schema), -1
    if not dirs:
        raise FileNotFoundError(f"no changes have been stored at {path}")
    return _read(spark, dirs), (batches[-1] if batches else upto)


def compact_changes(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    seq: str,
    scd_type: int,
    truncate_when: str | None = None,
) -> int:
    """Fold new batches into the base, bucket by touched bucket; returns the last batch that
    the base covers. What it replaces is left for readers that still use it, until
    ``remove_compacted``."""
    upto, base = _manifest(spark, path)
    batches = new_batches(spark, path)
    if not batches:
        return upto
    last, count = batches[-1], _buckets(spark, path)
    logs = {b: _numbers(spark, f"{path}/log/batch={b}", f"{_BUCKET}=") for b in batches}
    touched = sorted({bucket for found in logs.values() for bucket in found})
    if touched:
        dirs = [f"{path}/base/upto={base[b]}/{_BUCKET}={b}" for b in touched if b in base]
        dirs += [f"{path}/log/batch={b}/{_BUCKET}={bucket}" for b, found in logs.items() for bucket in found]
        reduced = reduce_changes(_read(spark, dirs), keys, seq, scd_type, truncate_when)
        _write(reduced, f"{path}/base/upto={last}", keys, count)
        # A bucket can come out empty, when a truncate leaves nothing of it.
        written = set(_numbers(spark, f"{path}/base/upto={last}", f"{_BUCKET}="))
        base = {b: u for b, u in base.items() if b not in touched} | {b: last for b in touched if b in written}
    write_text(spark, f"{path}/manifest/upto={last}", json.dumps(base))
    return last


def remove_compacted(spark: SparkSession, path: str) -> int:
    """Delete batches, bases and manifests that the newest manifest does not need; returns
    how many. Not while a reader may still hold an older one."""
    upto, base = _manifest(spark, path)
    old = [f"log/batch={b}" for b in _numbers(spark, f"{path}/log", "batch=") if b <= upto]
    old += [f"manifest/upto={m}" for m in _numbers(spark, f"{path}/manifest", "upto=") if m < upto]
    for u in _numbers(spark, f"{path}/base", "upto="):
        held = _numbers(spark, f"{path}/base/upto={u}", f"{_BUCKET}=")
        old += [f"base/upto={u}/{_BUCKET}={b}" for b in held if u <= upto and base.get(b) != u]
    for name in old:
        remove(spark, f"{path}/{name}")
    return len(old)


def read_scd1(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    truncate_when: str | None = None,
    except_cols: Sequence[str] = (),
    schema: StructType | str | None = None,
) -> DataFrame:
    rows, _ = stored_changes(spark, path, schema)
    return scd1(rows, keys, seq, delete_when, truncate_when, except_cols)


def read_scd2(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    seq: str,
    except_cols: Sequence[str] = (),
    delete_when: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    rows, _ = stored_changes(spark, path, schema)
    return scd2(rows, keys, seq, except_cols, delete_when)
