"""Projections, renames, filters and labels."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tarnwork.functions.scalars import as_column


def select(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols)


def flatten(df: DataFrame, fields: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """``{"city": "address.city"}``: struct fields or map entries as columns. A
    missing map key gives NULL. ``keep`` defaults to all columns."""
    kept = df.columns if keep is None else keep
    return df.select(*kept, *[F.col(path).alias(out) for out, path in fields.items()])


def with_columns(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(cols))


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def reorder(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*order)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def snake_case(name: str) -> str:
    """Every upper-case letter becomes an underscore and its lower-case form."""
    return re.sub("[A-Z]", lambda m: "_" + m.group().lower(), name)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def select_expr(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    return df.selectExpr(*exprs)


def label(
    df: DataFrame,
    out: str,
    branches: Sequence[tuple[Column | str, str]],
    default: str | None = None,
) -> DataFrame:
    """First matching branch wins; a NULL predicate does not match. Without branches every
    row gets the default."""
    if not branches:
        return df.withColumn(out, F.lit(default))
    case = F
    for pred, text in branches:
        case = case.when(F.expr(pred) if isinstance(pred, str) else pred, F.lit(text))
    return df.withColumn(out, case.otherwise(F.lit(default)))


def row_id(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Unique and increasing, with holes."""
    return df.withColumn(out, F.monotonically_increasing_id())


def columns_of_type(df: DataFrame, kind: type[DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def where(df: DataFrame, pred: Column | str) -> DataFrame:
    return df.where(pred)


def where_ci(df: DataFrame, col: str, value: str) -> DataFrame:
    """Equality that ignores case."""
    return df.where(F.upper(as_column(col)) == value.upper())


_COMPARED = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def where_number(df: DataFrame, col: str, op: str, value: float) -> DataFrame:
    """Rows whose text, read as a number, compares so with ``value``. Text that is no number
    compares with nothing, where a plain comparison of text and number would end the query."""
    return df.where(_COMPARED[op](F.col(col).try_cast("double"), F.lit(value)))
