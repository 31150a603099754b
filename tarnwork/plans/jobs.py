"""Small parameterised jobs: functions with arguments and results, for any scheduler."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tarnwork.functions.scalars import weekday_name
from tarnwork.operators.project import where_ci
from tarnwork.sources.readers import scan_csv
from tarnwork.sources.writers import observed_rows, write_files, write_table_if_any


def copy_csv(
    spark: SparkSession, src: str, target: str, fmt: str = "parquet", schema: str | None = None
) -> int:
    """Rewrite CSV files in another format; returns the number of rows. Types are
    inferred unless a schema is given."""
    counted, seen = observed_rows(scan_csv(spark, src, infer=schema is None, schema=schema))
    write_files(counted, target, fmt)
    return seen.get["rows"]


def write_department(
    spark: SparkSession, src: str, department: str, prefix: str = "dept_", path: str | None = None
) -> int:
    """One department of an employee file as its own table; nothing is written when
    there is none. Returns the number of rows."""
    rows = where_ci(scan_csv(spark, src), "department", department)
    return write_table_if_any(rows, f"{prefix}{department.lower()}", path)


def run_day(spark: SparkSession, moment: str, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> str:
    """Short weekday name of a run parameter."""
    one = spark.sql("SELECT :m AS m", args={"m": moment})
    return one.select(weekday_name(F.col("m"), fmt)).first()[0]
