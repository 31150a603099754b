"""Load the files of a directory that were not loaded before."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwork.sources.storage import exists, first_line
from tarnwork.sources.writers import observed_rows


#: Columns of Spark's binary file source; only the path is ever read.
_FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


#: Bytes read of the head of a file at a time.
_HEAD_BYTES = 1 << 14


def _by_header(spark: SparkSession, files: DataFrame) -> dict[str, list[str]]:
    """Paths grouped by the first line of the files. Heads are read where the tasks run; the
    driver gets a row per distinct header. Only files on a file system that is known to
    Hadoop alone are opened by the driver. Files without a line are left out."""
    block = _HEAD_BYTES

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        from pyarrow import fs

        def head(path: str) -> str | None:
            if path.startswith(("file:", "/")):
                system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            else:
                system, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
            with system.open_input_stream(place, compression="detect") as stream:
                data = b""
                while b"\n" not in data and (more := stream.read(block)):
                    data += more
            line = data.split(b"\n", 1)[0].removesuffix(b"\r").decode()
            return line if data else None

        for batch in frames:
            paths, heads, opened = batch.column("path").to_pylist(), [], []
            for path in paths:
                try:
                    heads.append(head(path))
                    opened.append(True)
                except (pa.ArrowException, ImportError, OSError):
                    heads.append(None)
                    opened.append(False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(heads, pa.string()), pa.array(opened)],
                names=["path", "head", "opened"],
            )

    read = files.select("path").mapInArrow(run, "path string, head string, opened boolean")
    grouped = read.groupBy("head", "opened").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: dict[str, list[str]] = defaultdict(list)
    for row in grouped:
        for path in row["paths"]:
            head = row["head"] if row["opened"] else first_line(spark, path)
            if head is not None:
                groups[head].append(path)
    return dict(sorted(groups.items()))


def _read_csv_by_header(
    spark: SparkSession, files: DataFrame, options: Mapping[str, str]
) -> DataFrame:
    """Files grouped by their header line, one read per distinct header, then a
    union by name. Reading unlike headers together would match columns by place."""
    sep = options.get("sep", ",")
    groups = _by_header(spark, files)
    merged = None
    for head, members in groups.items():
        names = next(csv.reader([head.lstrip("﻿")], delimiter=sep))
        schema = StructType()
        for name in names:
            schema = schema.add(name, "string")
        part = spark.read.schema(schema).options(header=True, **options).csv(members)
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged if merged is not None else spark.createDataFrame([], StructType())


def _read_batch(
    spark: SparkSession,
    files: DataFrame,
    paths: Sequence[str],
    fmt: str,
    schema: StructType | str | None,
    merge_schema: bool,
    options: Mapping[str, str],
) -> DataFrame:
    if fmt == "csv" and merge_schema and schema is None:
        return _read_csv_by_header(spark, files, options)
    opts = dict(options)
    if fmt == "csv":
        opts.setdefault("header", "true")
    if merge_schema and fmt in ("parquet", "orc"):
        opts["mergeSchema"] = "true"
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))


def load_new_files(
    spark: SparkSession,
    directory: str,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    pattern: str | None = None,
    merge_schema: bool = True,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    select: Sequence[str] | None = None,
    add_load_ts: str | None = None,
    files_per_batch: int = 1000,
) -> int:
    """Append every file of ``directory`` that the ``checkpoint`` has not seen to the
    Parquet directory ``target``; returns the number of rows loaded.

    The stream carries file names only. Each batch of at most ``files_per_batch``
    files is written to its own ``batch=<id>`` directory with overwrite, so a batch
    that is repeated after a failure replaces itself. CSV columns are text unless a
    schema is given, and with ``merge_schema`` files may differ in their columns.
    """
    names = spark.readStream.format("binaryFile").schema(_FILE_COLUMNS)
    names = names.option("maxFilesPerTrigger", files_per_batch)
    # Files are told apart by name, however old they are.
    names = names.option("maxFileAge", "36500d")
    if pattern:
        names = names.option("pathGlobFilter", pattern)
    loaded: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        # The names of one batch, files_per_batch at most, are what the reader is given.
        paths = sorted(r["path"] for r in batch.select("path").collect())
        if not paths:
            return
        rows = _read_batch(spark, batch, paths, fmt, schema, merge_schema, options or {})
        if not rows.columns:
            return
        if select:
            missing = {c: F.lit(None).cast("string") for c in select if c not in rows.columns}
            rows = rows.withColumns(missing).select(*select) if missing else rows.select(*select)
        if add_load_ts:
            rows = rows.withColumn(add_load_ts, F.current_timestamp())
        counted, seen = observed_rows(rows)
        counted.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        loaded.append(seen.get["rows"])

    query = (
        names.load(directory)
        .select("path")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(loaded)


def read_loaded(spark: SparkSession, target: str) -> DataFrame | None:
    """All rows loaded so far with the columns of all batches; None before the first."""
    if not exists(spark, target):
        return None
    # Folder names are no columns: a source may have a column of the same name.
    return spark.read.options(mergeSchema=True, recursiveFileLookup=True).parquet(target)
