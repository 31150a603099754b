"""Streams appended to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming.query import StreamingQuery

from tarnwork.sources.storage import list_names, remove, write_text

_MANIFEST = "_committed"


def append_stream(
    src: DataFrame, target: str, checkpoint: str, path: str | None = None
) -> StreamingQuery:
    """Append what is available to a table that has no other writer."""
    writer = src.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(target)


def append_flow(src: DataFrame, target: str, name: str, checkpoint: str) -> StreamingQuery:
    """One of several streams into the Parquet directory ``target``.

    Every micro-batch overwrites its own ``flow=<name>/batch=<id>`` directory, so a
    repeated batch replaces itself and flows never touch each other's files. Once it is
    written it is entered in the flow's manifest, one empty file per batch; readers take
    what is entered there and nothing else. The checkpoint and the flow's directory belong
    together.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"{target}/flow={name}"
        entry = f"{place}/{_MANIFEST}/batch={batch_id}"
        remove(spark, entry)  # a repeated batch is unfinished while it is replaced
        batch.write.mode("overwrite").parquet(f"{place}/batch={batch_id}")
        write_text(spark, entry, "")

    return (
        src.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_flows(target: str, flows: Mapping[str, DataFrame], checkpoints: str) -> None:
    """Run all flows side by side until what is available has been appended."""
    running = [
        append_flow(src, target, name, f"{checkpoints}/{name}") for name, src in flows.items()
    ]
    for query in running:
        query.awaitTermination()


def committed_batches(spark: SparkSession, target: str) -> list[str]:
    """Directories of all batches that the flows' manifests list."""
    flows = [n for n in list_names(spark, target) if n.startswith("flow=")]
    return [f"{target}/{f}/{b}" for f in sorted(flows) for b in sorted(list_names(spark, f"{target}/{f}/{_MANIFEST}"))]


def read_flows(
    spark: SparkSession, target: str, tagged: bool = False, schema: StructType | str | None = None
) -> DataFrame:
    """The union of all flows; ``tagged`` adds the flow's name as column ``flow``. Batches
    that are still being written, or were left half written, are not seen. Before anything
    has arrived, an empty table of ``schema``."""
    batches = committed_batches(spark, target)
    if not batches and schema is not None:
        rows = spark.createDataFrame([], schema)
        return rows.withColumn("flow", F.lit(None).cast("string")) if tagged else rows
    if not batches:
        raise FileNotFoundError(f"no batch has been written to {target}")
    # Folder names are no columns: a source may have a column of the same name.
    rows = spark.read.options(mergeSchema=True, recursiveFileLookup=True).parquet(*batches)
    if not tagged:
        return rows
    if "flow" in rows.columns:
        raise ValueError("the table has a column flow of its own")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/flow=([^/]+)/batch=", 1)
    return rows.withColumn("flow", F.url_decode(name))
