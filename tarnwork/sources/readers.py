"""Tables from rows, files and the catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwork.sources.storage import is_file


def literal_table(
    spark: SparkSession, rows: Sequence[Any], schema: Sequence[str] | StructType | str | None = None
) -> DataFrame:
    """Rows as tuples, ``Row`` objects or dicts, with names or a full schema. For
    plain scalars give ``"name type"``."""
    return spark.createDataFrame(rows, schema)


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    header: bool = True,
    infer: bool = False,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV from any Hadoop file system. Access options belong into the session or
    ``options``, never into code. Inferring types reads the data once more; give a
    schema for large inputs."""
    reader = spark.read.options(header=header, inferSchema=infer, **(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def scan_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def stream_files(
    spark: SparkSession,
    path: str,
    hints: StructType | str,
    pattern: str | None = None,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files of a directory as a stream with a fixed schema. CSV files have a header
    unless ``options`` say otherwise. A path that is a file streams just that."""
    opts = {"header": "true"} if fmt == "csv" else {}
    opts |= options or {}
    if is_file(spark, path):
        path, pattern = path.rsplit("/", 1)
    if pattern:
        opts["pathGlobFilter"] = pattern
    return spark.readStream.format(fmt).schema(hints).options(**opts).load(path)


def id_range(spark: SparkSession, start: int, stop: int) -> DataFrame:
    return spark.range(start, stop)


def param_table(spark: SparkSession, key: str, default: str, out: str = "value") -> DataFrame:
    """Session setting, or its default, as a one-row table."""
    value = spark.conf.get(key, default)
    return spark.sql("SELECT :v AS value", args={"v": value}).withColumnRenamed("value", out)


def describe_columns(df: DataFrame) -> DataFrame:
    """Column names and types in order, as a table."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "pos int, col_name string, data_type string")


def catalogue(spark: SparkSession, schema: str, properties: Sequence[str] = ()) -> DataFrame:
    """The tables of a schema and the session's views, a row each: ``table_name, kind, is_view,
    comment`` and one column for each property asked for. Only metadata is read."""
    rows = []
    for t in spark.catalog.listTables(schema):
        set_ = {}
        if properties and not t.isTemporary:
            name = ".".join(f"`{part}`" for part in (*(t.namespace or [schema]), t.name))
            set_ = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        rows.append((t.name, t.tableType, t.isTemporary or t.tableType == "VIEW", t.description, *map(set_.get, properties)))
    fields = ["table_name string", "kind string", "is_view boolean", "comment string", *(f"`{p}` string" for p in properties)]
    return spark.createDataFrame(rows, ", ".join(fields))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
