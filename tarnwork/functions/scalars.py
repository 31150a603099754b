"""Scalar helpers: thin compositions of built-in column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``["-amount", "product"]`` -> amount descending, product ascending.

    NULL placement is Spark's default: first when ascending, last when
    descending, i.e. NULL counts as the smallest value.
    """
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns; maps, which have no hash, go in as JSON text."""
    return F.xxhash64(
        *[
            F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def flip_order(order: Sequence[str]) -> list[str]:
    """The exact reverse of a sort order."""
    return [o[1:] if o.startswith("-") else "-" + o for o in order]


def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Strict parse; malformed text raises under ANSI mode."""
    return F.to_date(as_column(c), fmt) if fmt else F.to_date(as_column(c))


def try_parse_date(
    c: ColumnOrName, fmt: str, out_fmt: str | None = None, default: str | None = None
) -> Column:
    """Tolerant parse of one layout. Other layouts give NULL, or ``default``
    when the result is reformatted to text with ``out_fmt``."""
    parsed = F.try_to_date(as_column(c), fmt)
    if out_fmt is None:
        return parsed
    text = F.date_format(parsed, out_fmt)
    return text if default is None else F.coalesce(text, F.lit(default))


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    col = as_column(c)
    return F.to_timestamp(col, fmt) if fmt else F.to_timestamp(col)


def date_gap(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole days from ``earlier`` to ``later``; accepts dates, timestamps and ISO text."""
    return F.date_diff(as_column(later), as_column(earlier))


def minutes_between(earlier: ColumnOrName, later: ColumnOrName) -> Column:
    """Fractional minutes, exact to the microsecond."""
    micros = F.timestamp_diff("MICROSECOND", as_column(earlier), as_column(later))
    return micros / F.lit(60_000_000)


def split_part_or_null(c: ColumnOrName, sep: str, index: int, trim: bool = False) -> Column:
    """Element of delimited text; NULL instead of an error when it is missing."""
    part = F.get(F.split(as_column(c), sep), F.lit(index))
    return F.trim(part) if trim else part


def weekday_name(c: ColumnOrName, fmt: str | None = None, short: bool = True) -> Column:
    """Weekday of a timestamp column or of text in layout ``fmt``."""
    ts = parse_timestamp(c, fmt) if fmt else as_column(c)
    return F.date_format(ts, "E" if short else "EEEE")
