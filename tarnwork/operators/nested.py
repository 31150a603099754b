"""Arrays, delimited text and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwork.functions.scalars import split_part_or_null


def explode(df: DataFrame, arr: str, out: str) -> DataFrame:
    """One row per element, other columns kept. NULL and empty arrays give no row."""
    return df.withColumn(out, F.explode(arr))


def explode_pos(df: DataFrame, arr: str, pos: str, val: str) -> DataFrame:
    """As ``explode``, with the position from 0; the array itself is dropped."""
    others = [c for c in df.columns if c != arr]
    return df.select(*others, F.posexplode(arr).alias(pos, val))


def split_rows(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(F.split(F.col(col), sep)))


def split_columns(
    df: DataFrame, col: str, sep: str, names: Sequence[str], trim: bool = False
) -> DataFrame:
    """Parts by index. A missing part is NULL; blanks stay unless ``trim``."""
    return df.withColumns(
        {n: split_part_or_null(col, sep, i, trim) for i, n in enumerate(names)}
    )


def parse_json(
    df: DataFrame,
    col: str,
    schema: StructType | str,
    explode_field: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """JSON text to columns; malformed text gives NULL fields. ``explode_field``
    adds one row per element of an inner array, under ``out``."""
    parsed = df.withColumn("__json", F.from_json(col, schema))
    others = [c for c in df.columns if c != col]
    flat = parsed.select(*others, "__json.*")
    return explode(flat, explode_field, out or explode_field) if explode_field else flat
