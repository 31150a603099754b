"""Gaps, sessions, streaks, missing dates and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwork.functions.scalars import date_gap, minutes_between
from tarnwork.operators.aggregate import with_group_stats
from tarnwork.operators.skew import HOT_ROWS, running_window
from tarnwork.operators.window import (
    earliest,
    following,
    previous,
    running_min,
    top_n,
    top_ranked,
)

_START = Window.unboundedPreceding


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def islands(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    breaks: Callable[[Column, Column], Column],
    out: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number the runs of rows per key. A run ends where ``breaks(prev, cur)``
    holds or is NULL; the first row of a key starts run 1.

    The first row of a slice does not see its predecessor, so it counts as no
    break locally; the break is decided from the slices' first and last values.
    """
    def local(w):
        return {
            "__first": F.row_number().over(w) == 1,
            "__prev": F.lag(order).over(w),
            "__break": F.when(F.col("__first"), 0).otherwise(
                F.coalesce(breaks(F.col("__prev"), F.col(order)), F.lit(True)).cast("int")
            ),
            "__runs": F.sum("__break").over(w.rowsBetween(_START, 0)),
        }

    def before(w):
        entry = F.coalesce(breaks(F.col("__prev_last"), F.col("__lo")), F.lit(True)).cast("int")
        return {
            "__prev_last": F.lag("__hi").over(w),
            "__entry": entry,
            "__base": F.sum("__entry").over(w.rowsBetween(_START, 0))
            + F.coalesce(F.sum("__inside").over(w.rowsBetween(_START, -1)), F.lit(0)),
        }

    return running_window(
        df,
        _keys(key),
        [order],
        local=local,
        totals={"__lo": F.min(order), "__hi": F.max(order), "__inside": F.sum("__break")},
        before=before,
        combine={out: (F.col("__runs") + F.coalesce(F.col("__base"), F.lit(1))).cast("long")},
        hot_rows=hot_rows,
    )


# -- intervals between events ------------------------------------------------


def avg_interval(
    df: DataFrame, key: str | Sequence[str], date: str, out: str = "avg_days"
) -> DataFrame:
    """Mean days between consecutive events. The differences telescope, so the
    mean is (last - first) / (n - 1): one aggregation, no ordering. One event
    gives NULL."""
    n = F.count(date)
    return df.groupBy(*_keys(key)).agg(
        F.when(n > 1, date_gap(F.max(date), F.min(date)) / (n - 1)).alias(out)
    )


def days_since_previous(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    out: str = "gap_days",
    prev: str = "prev_date",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    with_prev = previous(df, _keys(key), [date], date, prev, hot_rows)
    return with_prev.withColumn(out, date_gap(date, prev))


def gaps_over(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    days: int,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rows that come more than ``days`` days after the key's previous row."""
    return days_since_previous(df, key, date, hot_rows=hot_rows).where(F.col("gap_days") > days)


def rapid_repeats(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    minutes: float,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Events less than ``minutes`` after the key's previous event."""
    return (
        previous(df, _keys(key), [ts], ts, "prev_ts", hot_rows)
        .withColumn("gap_minutes", minutes_between("prev_ts", ts))
        .where(F.col("gap_minutes") < minutes)
    )


def rapid_followed(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    minutes: float,
    out: str = "suspicious",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Every event, with ``next_ts``, ``gap_minutes`` and a flag: whether another event of the
    key comes within ``minutes``."""
    events = following(df, _keys(key), [ts], ts, "next_ts", hot_rows)
    gap = minutes_between(ts, "next_ts")
    return events.withColumns({"gap_minutes": gap, out: F.coalesce(gap < minutes, F.lit(False))})


def gap_flag(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    minutes: float,
    out: str = "gap_flag",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """1 when the previous event is less than ``minutes`` away or there is none, else 2."""
    return (
        previous(df, _keys(key), [ts], ts, "prev_ts", hot_rows)
        .withColumn("gap_minutes", F.coalesce(minutes_between("prev_ts", ts), F.lit(0.0)))
        .withColumn(out, F.when(F.col("gap_minutes") < minutes, 1).otherwise(2))
    )


# -- sessions and streaks ------------------------------------------------------


def sessionize(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    minutes: float,
    out: str = "session_id",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Session numbers per key; a gap of more than ``minutes`` starts a new one."""
    return islands(df, key, ts, lambda p, c: minutes_between(p, c) > minutes, out, hot_rows)


def session_summary(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    minutes: float,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    return (
        sessionize(df, key, ts, minutes, "session_id", hot_rows)
        .groupBy(*_keys(key), "session_id")
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("activity_count"),
        )
    )


def distinct_days(df: DataFrame, key: str | Sequence[str], date: str) -> DataFrame:
    """One row per key and calendar day. Duplicates fall away before the shuffle,
    and a key is left with no more rows than the calendar has days."""
    return df.select(*_keys(key), F.col(date).cast("date").alias(date)).distinct()


def streaks(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    dedupe: bool = True,
    hot_rows: int | None = HOT_ROWS,
    names: tuple[str, str, str] = ("from_day", "to_day", "n_days"),
) -> DataFrame:
    """Runs of consecutive days: first day, last day and their number, called ``names``. ``dedupe=False`` lets a repeated day start a new run."""
    days = distinct_days(df, key, date) if dedupe else df
    return (
        islands(
            days,
            key,
            date,
            lambda p, c: date_gap(c, p) != 1,
            "streak_id",
            None if dedupe else hot_rows,
        )
        .groupBy(*_keys(key), "streak_id")
        .agg(
            F.min(date).alias(names[0]),
            F.max(date).alias(names[1]),
            (date_gap(F.max(date), F.min(date)) + 1).alias(names[2]),
        )
    )


# -- calendars -----------------------------------------------------------------


def date_spine(
    df: DataFrame, key: str | Sequence[str], date: str, out: str = "spine_date"
) -> DataFrame:
    """Every date of a key from its first to its last."""
    d = F.col(date).cast("date")
    return (
        df.groupBy(*_keys(key))
        .agg(F.min(d).alias("__lo"), F.max(d).alias("__hi"))
        .select(*_keys(key), F.explode(F.sequence("__lo", "__hi")).alias(out))
    )


def missing_ranges(df: DataFrame, key: str | Sequence[str], date: str) -> DataFrame:
    """Missing dates as closed ranges. Each hole lies between two neighbouring
    days of the key, so the spine is not built."""
    days = distinct_days(df, key, date)
    gap = previous(days, _keys(key), [date], date, "__prev", hot_rows=None)
    return gap.where(date_gap(date, "__prev") > 1).select(
        *_keys(key),
        F.date_add("__prev", 1).alias("missing_from"),
        F.date_sub(date, 1).alias("missing_to"),
    )


def missing_dates(
    df: DataFrame, key: str | Sequence[str], date: str, out: str = "missing_date"
) -> DataFrame:
    """Dates between a key's first and last on which it has no row, spelled out from the
    missing ranges."""
    ranges = missing_ranges(df, key, date)
    return ranges.select(*_keys(key), F.explode(F.sequence("missing_from", "missing_to")).alias(out))


def missing_envelope(df: DataFrame, key: str | Sequence[str], date: str) -> DataFrame:
    """First and last missing date per key. Covers present days as well when a
    key has several holes; use ``missing_ranges`` for the holes themselves."""
    return (
        missing_ranges(df, key, date)
        .groupBy(*_keys(key))
        .agg(
            F.min("missing_from").alias("missing_from"),
            F.max("missing_to").alias("missing_to"),
        )
    )


# -- customer life cycle ---------------------------------------------------------


def retention(
    df: DataFrame,
    key: str | Sequence[str],
    date: str,
    days: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    """Rows that fall on day N after the key's first date, N in ``days``."""
    return (
        with_group_stats(df, _keys(key), {"first_date": F.min(date)})
        .withColumn("day_n", date_gap(date, "first_date"))
        .where(F.col("day_n").isin(list(days)))
    )


def days_to_first(
    activations: DataFrame,
    events: DataFrame,
    key: str,
    activated: str,
    happened: str,
    out: str = "days_to_first",
    only_after: bool = False,
) -> DataFrame:
    """Days from activation to the key's first event. Without ``only_after`` the
    first event may lie before the activation and the result may be negative.

    With it, both tables are put in one order per key, latest first, and each
    activation takes the smallest event time met so far: no pairs are formed.
    """
    if only_after:
        starts = activations.where(F.col(activated).isNotNull()).withColumns(
            {"__ts": F.col(activated), "__start": F.lit(True)}
        )
        hits = events.where(F.col(happened).isNotNull()).select(
            key, F.col(happened).alias("__ts"), F.col(happened).alias("__hit")
        )
        both = starts.unionByName(hits, allowMissingColumns=True)
        first = running_min(both, [key], ["-__ts"], "__hit", happened)
        return (
            first.where(F.col("__start") & F.col(happened).isNotNull())
            .select(*activations.columns, happened)
            .withColumn(out, date_gap(happened, activated))
        )
    first = earliest(events, [key], [happened])
    return activations.join(first, key).withColumn(out, date_gap(happened, activated))


def first_and_last(df: DataFrame, key: str | Sequence[str], date: str) -> DataFrame:
    """Rows at the key's first or last date."""
    bounded = with_group_stats(
        df, _keys(key), {"__lo": F.min(date), "__hi": F.max(date)}
    )
    at_edge = (F.col(date) == F.col("__lo")) | (F.col(date) == F.col("__hi"))
    return bounded.where(at_edge).drop("__lo", "__hi")


def latest_change(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    amount: str,
    out: str = "change",
) -> DataFrame:
    """The two latest rows per key (``order`` sorts the latest first); the older of
    the two holds how much the newer amount differs from it."""
    two = top_n(df, _keys(key), order, 2, "recency")
    # At most two rows per key are left, so the plain window is enough.
    return previous(two, _keys(key), ["recency"], amount, "newer_amount", None).withColumn(
        out, F.col("newer_amount") - F.col(amount)
    )


def busiest_buckets(df: DataFrame, ts: str, bands: Sequence[tuple[int, str]], n: int) -> DataFrame:
    """Event counts by weekday and hour band, ranks 1..n. ``bands`` gives the first hour of
    each band and its name; hours before the first band belong to the last one."""
    ordered = sorted(bands)
    band = F.lit(ordered[-1][1])
    for hour, name in ordered:
        band = F.when(F.hour(ts) >= hour, name).otherwise(band)
    seen = df.select(F.date_format(ts, "EEEE").alias("weekday"), band.alias("band"))
    return top_ranked(seen.groupBy("weekday", "band").agg(F.count(F.lit(1)).alias("events")), ["-events"], n)
