"""Defaults, imputation and removal of missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.aggregate import median, with_scalars


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant per column. A value is cast to its column's type, so a fraction
    filled into an integer column is cut off; ``impute`` does not do that."""
    return df.na.fill(dict(values))


def impute(df: DataFrame, cols: str | Sequence[str], strategy: str = "mean") -> DataFrame:
    """Replace NULL by the column's mean or exact median; the columns become double."""
    names = [cols] if isinstance(cols, str) else list(cols)
    order = df.columns
    if strategy == "mean":
        filled = with_scalars(df, {f"__m_{c}": F.avg(c) for c in names})
        out = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")) for c in names}
        return filled.withColumns(out).select(*order)
    if strategy == "median":
        row = median(df, names).select(F.struct(*names).alias("m")).scalar()
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), row[c]) for c in names})
    raise ValueError("strategy is 'mean' or 'median'")


def drop_null(
    df: DataFrame, subset: Sequence[str] | None = None, how: str = "any"
) -> DataFrame:
    return df.dropna(how=how, subset=list(subset) if subset else None)


def default_text(df: DataFrame, defaults: Mapping[str, str], suffix: str = "") -> DataFrame:
    return df.withColumns(
        {c + suffix: F.coalesce(F.col(c), F.lit(text)) for c, text in defaults.items()}
    )


def join_text(
    df: DataFrame, cols: Sequence[str], out: str, sep: str = ", ", skip_empty: bool = False
) -> DataFrame:
    """Columns joined by ``sep``. NULL counts as empty text and still gets its
    separator, unless ``skip_empty`` leaves NULL and empty parts out."""
    if skip_empty:
        parts = [F.when(F.col(c) != "", F.col(c)) for c in cols]
    else:
        parts = [F.coalesce(F.col(c), F.lit("")) for c in cols]
    return df.withColumn(out, F.concat_ws(sep, *parts))
