"""Slowly changing dimensions from a change feed.

Both types follow the sequence column, never the order of arrival, so late
changes land where they belong. ``reduce_changes`` shrinks a feed without
changing what the two operators make of it; the stream form is built on that. Of two
changes with equal key and sequence the one with the larger row hash counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.skew import HOT_ROWS, bounded_window
from tarnwork.operators.window import latest

START_AT = "__START_AT"
END_AT = "__END_AT"


def _is(pred: str | None) -> Column:
    return F.coalesce(F.expr(pred), F.lit(False)) if pred else F.lit(False)


def _latest_per_key(
    changes: DataFrame, keys: Sequence[str], seq: str, truncate_when: str | None
) -> DataFrame:
    rows = changes
    if truncate_when:
        cut = changes.where(_is(truncate_when)).agg(F.max(seq).alias("t")).scalar()
        rows = changes.where(~_is(truncate_when)).where(cut.isNull() | (F.col(seq) >= cut))
    return latest(rows, keys, [seq])


def reduce_changes(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    scd_type: int,
    truncate_when: str | None = None,
) -> DataFrame:
    """Type 1: the newest change per key, deletes included, and the newest truncate.
    Type 2: one change per key and sequence."""
    if scd_type == 2:
        return latest(changes, [*keys, seq], [seq])
    newest = _latest_per_key(changes, keys, seq, truncate_when)
    if not truncate_when:
        return newest
    marker = changes.where(_is(truncate_when)).orderBy(F.col(seq).desc()).limit(1)
    return newest.unionByName(marker)


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    truncate_when: str | None = None,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Current row per key. A truncate at sequence t removes all changes before t,
    whenever they arrive; its own row is not kept."""
    newest = _latest_per_key(changes, keys, seq, truncate_when)
    return newest.where(~_is(delete_when)).drop(*except_cols)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    except_cols: Sequence[str] = (),
    delete_when: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Every version of a key with the interval it was valid in; open versions have
    no end. A delete closes the version before it; without ``delete_when`` every
    change is a version."""
    # The last change of a sequence is followed by one of a later sequence, which is where
    # it ends; so one sort finds both the change that counts and its end.
    last, more = F.lead(seq), F.lead(F.lit(True))
    closed = bounded_window(changes, keys, [seq], lambda w: {END_AT: last.over(w), "__more": more.over(w)}, 1, hot_rows)
    counts = F.col("__more").isNull() | ~F.col(END_AT).eqNullSafe(F.col(seq))
    return (
        closed.where(counts)
        .drop("__more")
        .where(~_is(delete_when))
        .withColumn(START_AT, F.col(seq))
        .drop(*except_cols)
    )


def current(df: DataFrame) -> DataFrame:
    return df.where(F.col(END_AT).isNull())


def history(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).orderBy(START_AT)
