"""Files and catalogue tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A text literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str, comment: str | None = None) -> None:
    note = f" COMMENT {sql_text(comment)}" if comment else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{note}")


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Managed table, or an external one at ``path``."""
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def observed_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted by whatever action runs next."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table_if_any(df: DataFrame, name: str, path: str | None = None) -> int:
    """Write only when there is a row; returns the number of rows. The count comes
    from the write itself."""
    if df.isEmpty():
        return 0
    counted, seen = observed_rows(df)
    save_table(counted, name, path=path)
    return seen.get["rows"]


def ctas(spark: SparkSession, name: str, df: DataFrame, path: str | None = None) -> DataFrame:
    """Create a table from a query; fails if it exists. Creates the schema of a
    two-part name."""
    if "." in name:
        create_schema(spark, name.rsplit(".", 1)[0])
    save_table(df, name, mode="errorifexists", path=path)
    return spark.table(name)


def clone_table(spark: SparkSession, src: str, dst: str, path: str | None = None) -> DataFrame:
    """Independent copy; nothing happens when the copy exists."""
    if not spark.catalog.tableExists(dst):
        save_table(spark.table(src), dst, mode="errorifexists", path=path)
    return spark.table(dst)


def append_query(spark: SparkSession, target: str, df: DataFrame, limit: int | None = None) -> None:
    """Append by position; with ``limit`` the first rows in partition order, which stay in
    their partitions."""
    (df if limit is None else prefix_rows(df, limit)).write.insertInto(target)


def append_rows(spark: SparkSession, target: str, rows: Sequence[Sequence[Any]]) -> None:
    """Append literal rows, typed by the table."""
    spark.createDataFrame(list(rows), spark.table(target).schema).write.insertInto(target)


def add_columns(df: DataFrame, cols: Mapping[str, Column | str]) -> DataFrame:
    """Nullable columns (a type name as text) or columns set on every row."""
    return df.withColumns(
        {n: F.lit(None).cast(c) if isinstance(c, str) else c for n, c in cols.items()}
    )


# -- sizes -------------------------------------------------------------------


def _row_bytes(df: DataFrame) -> Column:
    return F.octet_length(F.to_json(F.struct(*df.columns)))


def estimate_bytes(df: DataFrame) -> DataFrame:
    """One row: rows, bytes of the rows as JSON text, and the same in MB and GB."""
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
    )
    return sums.withColumns(
        {"mb": F.col("bytes") / (1024 * 1024), "gb": F.col("bytes") / (1024 * 1024 * 1024)}
    )


#: Bits of a generated id that number the rows inside a partition.
_ROW_BITS = 33


def prefix_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in partition order, left where they are. ``limit`` moves
    up to ``n`` rows of every partition to one task, which is fine for a few rows
    only. Meant for tables and files, whose partitions are the same in every run."""
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("c"))
    end = None
    for row in sizes.orderBy("p").toLocalIterator():
        if n < row["c"]:
            end = (row["p"] << _ROW_BITS) + n
            break
        n -= row["c"]
    if end is None:
        return df
    numbered = df.withColumn("__id", F.monotonically_increasing_id())
    return numbered.where(F.col("__id") < end).drop("__id")


def limit_to_bytes(df: DataFrame, budget_mb: float, probe_rows: int = 1000) -> DataFrame:
    """As many rows as fit a byte budget, judged by the mean size of a few rows."""
    sizes = [r[0] for r in df.select(_row_bytes(df)).head(probe_rows)]
    if not sizes:
        return df
    return prefix_rows(df, int(budget_mb * 1024 * 1024 * len(sizes) / sum(sizes)))
