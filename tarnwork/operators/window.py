"""Rankings, neighbours, running values, and sorted prefixes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwork.functions.scalars import flip_order, row_hash, sort_columns
from tarnwork.operators.skew import (
    HOT_ROWS,
    SLICES_PER_UNIT,
    TIE,
    attach,
    bounded_window,
    first_rows,
    has_hot_key,
    running_window,
    measured,
    tie_column,
)

_START = Window.unboundedPreceding


def _earlier(w):
    return w.rowsBetween(_START, -1)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


# -- numbering -------------------------------------------------------------


def number_rows(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    out: str = "row_number",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Row number of every row inside its group."""
    return running_window(
        df,
        part,
        order,
        local=lambda w: {"__rn": F.row_number().over(w)},
        totals={"__rows": F.count(F.lit(1))},
        before=lambda w: {"__base": F.sum("__rows").over(_earlier(w))},
        combine={out: (F.col("__rn") + _zero("__base")).cast("long")},
        hot_rows=hot_rows,
    )


def _by_level(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, Column],
    build: Callable[[DataFrame], DataFrame],
    out: str,
) -> DataFrame:
    """Results that all peers share, found once per distinct sort value. Peers are
    combined before the first shuffle, and the join back can be split where one
    value is hot."""
    level = [*part, *dict.fromkeys(o.lstrip("-") for o in order)]
    named = [c.alias(n) for n, c in aggs.items()]
    levels = df.groupBy(*level).agg(*named) if named else df.select(*level).distinct()
    return attach(df, build(levels).select(*level, out), level)


def _peers(
    df: DataFrame, part: Sequence[str], order: Sequence[str], hot_rows: int | None, many_ties: bool | None
) -> tuple[int | None, bool]:
    """How to evaluate a window whose peers share one result: ``hot_rows`` as it holds, and
    whether to work per distinct sort value. Peers cannot be cut, so that is done where a
    single value of a hot key has more rows than a slice should."""
    if many_ties is not None:
        return hot_rows, many_ties
    hot_rows = measured(df, part, hot_rows)
    if hot_rows is None:
        return None, False
    level = [*part, *dict.fromkeys(o.lstrip("-") for o in order)]
    return hot_rows, has_hot_key(df, level, max(1, hot_rows // SLICES_PER_UNIT))


def rank(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    out: str = "rank",
    hot_rows: int | None = HOT_ROWS,
    many_ties: bool | None = None,
) -> DataFrame:
    """Rank with gaps. Peers share all sort columns, hence the slice. With
    ``many_ties`` the ranks are found per distinct sort value and joined back; by
    default where a sample shows one value of a hot key to be hot itself."""
    hot_rows, many_ties = _peers(df, part, order, hot_rows, many_ties)
    if many_ties:
        return _by_level(
            df,
            part,
            order,
            {"__rows": F.count(F.lit(1))},
            lambda levels: running_sum(
                levels, part, order, "__rows", "__upto", "rows", hot_rows
            ).withColumn(out, F.col("__upto") - F.col("__rows") + 1),
            out,
        )
    return running_window(
        df,
        part,
        order,
        local=lambda w: {"__rk": F.rank().over(w)},
        totals={"__rows": F.count(F.lit(1))},
        before=lambda w: {"__base": F.sum("__rows").over(_earlier(w))},
        combine={out: (F.col("__rk") + _zero("__base")).cast("long")},
        hot_rows=hot_rows,
        peers=True,
    )


def dense_rank(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    out: str = "dense_rank",
    hot_rows: int | None = HOT_ROWS,
    many_ties: bool | None = None,
) -> DataFrame:
    """Rank without gaps; ``many_ties`` as for ``rank``."""
    hot_rows, many_ties = _peers(df, part, order, hot_rows, many_ties)
    if many_ties:
        return _by_level(
            df, part, order, {}, lambda levels: number_rows(levels, part, order, out, hot_rows), out
        )
    return running_window(
        df,
        part,
        order,
        local=lambda w: {"__dr": F.dense_rank().over(w)},
        totals={"__levels": F.max("__dr")},
        before=lambda w: {"__base": F.sum("__levels").over(_earlier(w))},
        combine={out: (F.col("__dr") + _zero("__base")).cast("long")},
        hot_rows=hot_rows,
        peers=True,
    )


# -- first rows of a group -------------------------------------------------
#
# row_number/rank compared with a constant is planned as WindowGroupLimit: every
# map task keeps at most n rows per group (and ties, for rank) before the
# shuffle, so a hot group arrives as n rows per map task. That is much for a large
# n, and Spark gives it up above 1,000; then the rows of hot groups that lie behind
# a bound from a sample are left out first.

#: Largest n for which every map task may send n rows of a group.
GROUP_LIMIT = 100


def top_n(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    n: int,
    out: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """First ``n`` rows of each group in ``order``, ties by the rows' hash; ``out`` keeps
    the row number."""
    tie = [*order, tie_column(order)]
    rows = df.withColumn(TIE, row_hash(df))
    if n > GROUP_LIMIT and measured(df, part, hot_rows) is not None:
        rows = first_rows(rows, part, tie, n, hot_rows)
    name = out or "__rn"
    numbered = rows.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*sort_columns(tie))))
    kept = numbered.where(F.col(name) <= n).drop(TIE)
    return kept if out else kept.drop(name)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key when sorted ascending by ``order``."""
    return top_n(df, keys, flip_order(order), 1)


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_n(df, keys, order, 1)


def group_max_rows(df: DataFrame, part: Sequence[str], col: str) -> DataFrame:
    """All rows that carry the maximum of ``col`` in their group, ties kept. Where the
    maxima turn out small, adaptive execution broadcasts them."""
    peak = df.groupBy(*part).agg(F.max(col).alias("__peak"))
    return attach(df, peak, part, "inner").where(F.col(col) == F.col("__peak")).drop("__peak")


def top_ranked(df: DataFrame, order: Sequence[str], n: int, out: str = "rank") -> DataFrame:
    """Rows ranked 1..n over the whole table, ties kept. Rows are counted per distinct
    sort value; the first ``n`` values are ranked by the counts before them and joined
    back, so tied rows stay where they are."""
    values = list(dict.fromkeys(o.lstrip("-") for o in order))
    counts = df.groupBy(*values).agg(F.count(F.lit(1)).alias("__rows"))
    w = _earlier(Window.orderBy(*sort_columns(order)))
    ranked = (
        top_k(counts, order, n)
        .withColumn("__rank", F.coalesce(F.sum("__rows").over(w), F.lit(0)) + 1)
        .where(F.col("__rank") <= n)
        .select(*values, F.col("__rank").cast("int").alias(out))
    )
    return attach(df, ranked, values, "inner")


# -- running values --------------------------------------------------------


def running_sum(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    out: str = "running_sum",
    frame: str = "range",
    hot_rows: int | None = HOT_ROWS,
    many_ties: bool | None = None,
) -> DataFrame:
    """``frame="range"`` gives peers the same value, for which ``many_ties`` works
    as for ``rank``; ``"rows"`` counts row by row."""
    if frame not in ("range", "rows"):
        raise ValueError("frame is 'range' or 'rows'")
    if frame == "range":
        hot_rows, many_ties = _peers(df, part, order, hot_rows, many_ties)
    if many_ties and frame == "range":
        return _by_level(
            df,
            part,
            order,
            {"__sum": F.sum(col)},
            lambda levels: running_sum(levels, part, order, "__sum", out, "rows", hot_rows),
            out,
        )

    def framed(w):
        return w.rangeBetween(_START, 0) if frame == "range" else w.rowsBetween(_START, 0)

    here, base = F.col("__here"), F.col("__base")
    return running_window(
        df,
        part,
        order,
        local=lambda w: {"__here": F.sum(col).over(framed(w))},
        totals={"__sum": F.sum(col)},
        before=lambda w: {"__base": F.sum("__sum").over(_earlier(w))},
        combine={out: F.when(base.isNull(), here).when(here.isNull(), base).otherwise(base + here)},
        hot_rows=hot_rows,
        peers=frame == "range",
    )


def running_min(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    out: str = "running_min",
    hot_rows: int | None = HOT_ROWS,
    many_ties: bool | None = None,
) -> DataFrame:
    """Minimum of the row, its peers and all rows before; ``many_ties`` as for ``rank``."""
    hot_rows, many_ties = _peers(df, part, order, hot_rows, many_ties)
    if many_ties:
        return _by_level(
            df,
            part,
            order,
            {"__low": F.min(col)},
            lambda levels: running_min(levels, part, order, "__low", out, hot_rows, False),
            out,
        )
    return running_window(
        df,
        part,
        order,
        local=lambda w: {"__here": F.min(col).over(w)},
        totals={"__low": F.min(col)},
        before=lambda w: {"__base": F.min("__low").over(_earlier(w))},
        combine={out: F.least(F.col("__here"), F.coalesce(F.col("__base"), F.col("__here")))},
        hot_rows=hot_rows,
        peers=True,
    )


def moving_avg(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    rows: int = 2,
    out: str = "moving_avg",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mean of the row and the ``rows`` rows before it."""
    return bounded_window(
        df,
        part,
        order,
        lambda w: {out: F.avg(col).over(w.rowsBetween(-rows, 0))},
        reach=rows,
        hot_rows=hot_rows,
    )


# -- neighbours ------------------------------------------------------------


def previous(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    out: str = "previous",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    return bounded_window(
        df, part, order, lambda w: {out: F.lag(col).over(w)}, reach=1, hot_rows=hot_rows
    )


def following(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    col: str,
    out: str = "following",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    return bounded_window(
        df, part, order, lambda w: {out: F.lead(col).over(w)}, reach=1, hot_rows=hot_rows
    )


# -- whole-table bounds ----------------------------------------------------


def with_global_bounds(
    df: DataFrame, col: str, low: str = "min_value", high: str = "max_value"
) -> DataFrame:
    """Table minimum and maximum beside each row, as a scalar subquery: the table
    is aggregated in parallel and only two numbers are handed to the tasks."""
    bounds = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("b")).scalar()
    return df.withColumns({low: bounds["lo"], high: bounds["hi"]})


def extremes(df: DataFrame, col: str, names: Mapping[str, str], out: str = "extreme") -> DataFrame:
    """Rows at the table's largest or smallest value, with ``names["max"]`` or
    ``names["min"]`` beside them; where all values are equal, with the first."""
    ends = df.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high")).alias("e")).scalar()
    here = df.where(F.col(col).isin(ends["low"], ends["high"]))
    return here.withColumn(out, F.when(F.col(col) < ends["high"], F.lit(names["min"])).otherwise(F.lit(names["max"])))


def extremes_union(df: DataFrame, col: str, names: Mapping[str, str], out: str = "extreme") -> DataFrame:
    """As ``extremes``, but a row at both ends appears twice."""
    ends = df.agg(F.struct(F.max(col).alias("max"), F.min(col).alias("min")).alias("e")).scalar()
    at = [F.when(F.col(col) == ends[end], F.lit(names[end])) for end in ("max", "min")]
    return df.withColumn(out, F.explode(F.array_compact(F.array(*at))))


# -- sets, sorts and limits ------------------------------------------------


def union(a: DataFrame, b: DataFrame, by_name: bool = False) -> DataFrame:
    return a.unionByName(b) if by_name else a.union(b)


def sort(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*sort_columns(order))


def limit(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Sort and limit in one step (TakeOrderedAndProject): each task keeps k rows."""
    return df.orderBy(*sort_columns(order)).limit(k)
