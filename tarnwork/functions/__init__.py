from tarnwork.functions.scalars import (
    date_gap,
    minutes_between,
    parse_date,
    parse_timestamp,
    sort_columns,
    split_part_or_null,
    try_parse_date,
    weekday_name,
)

__all__ = [
    "date_gap",
    "minutes_between",
    "parse_date",
    "parse_timestamp",
    "sort_columns",
    "split_part_or_null",
    "try_parse_date",
    "weekday_name",
]
