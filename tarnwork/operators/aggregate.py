"""Grouped aggregates, pivots, exact medians and array building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarnwork.functions.scalars import sort_columns
from tarnwork.operators.skew import HOT_ROWS, attach
from tarnwork.operators.window import number_rows

Aggs = Mapping[str, Column]


def _named(aggs: Aggs) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def group(
    df: DataFrame, keys: Sequence[str], aggs: Aggs, having: Column | str | None = None
) -> DataFrame:
    out = df.groupBy(*keys).agg(*_named(aggs))
    return out if having is None else out.where(having)


def group_profile(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Row count and, per measure, sum, mean, minimum and maximum in one pass."""
    aggs: dict[str, Column] = {"row_count": F.count(F.lit(1))}
    for m in measures:
        aggs |= {
            f"sum_{m}": F.sum(m),
            f"avg_{m}": F.avg(m),
            f"min_{m}": F.min(m),
            f"max_{m}": F.max(m),
        }
    return group(df, keys, aggs)


def top_groups(
    df: DataFrame, keys: Sequence[str], aggs: Aggs, by: Sequence[str], n: int
) -> DataFrame:
    return group(df, keys, aggs).orderBy(*sort_columns(by)).limit(n)


def scalar_agg(df: DataFrame, aggs: Aggs) -> DataFrame:
    """Whole-table aggregates as a one-row table."""
    return df.agg(*_named(aggs))


def with_scalars(df: DataFrame, aggs: Aggs) -> DataFrame:
    """Whole-table aggregates beside each row, through one scalar subquery."""
    row = df.agg(F.struct(*_named(aggs)).alias("s")).scalar()
    return df.withColumns({n: row[n] for n in aggs})


def with_group_stats(df: DataFrame, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """Aggregates of its group beside each row. The aggregate is combined before
    its shuffle, and the join back can be split by the adaptive planner where a
    key is hot, which a window over the key cannot. An aggregate that turns out small
    is broadcast by adaptive execution, so the rows stay where they are."""
    return attach(df, group(df, keys, aggs), keys)


# -- reshaping -------------------------------------------------------------


def pivot(
    df: DataFrame,
    keys: Sequence[str],
    on: str,
    values: Sequence[object] | None,
    measure: str,
    how: str = "sum",
) -> DataFrame:
    """Cells without rows are NULL. Naming the ``values`` saves the job that looks
    them up."""
    agg = {"sum": F.sum, "max": F.max}[how](measure)
    return df.groupBy(*keys).pivot(on, list(values) if values else None).agg(agg)


def pivot_share(
    df: DataFrame,
    cells: Sequence[str],
    digits: int | None = None,
    total: str = "total",
    suffix: str = "_share",
    null_as_zero: bool = False,
) -> DataFrame:
    """Row total of the cells and the percentage of each. A NULL cell makes the
    total NULL unless ``null_as_zero``."""
    vals = {c: F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c) for c in cells}
    first, *rest = vals.values()
    row_total = first
    for v in rest:
        row_total = row_total + v
    shares = {}
    for c, v in vals.items():
        share = v / F.nullif(row_total, F.lit(0)) * 100
        shares[c + suffix] = share if digits is None else F.round(share, digits)
    return df.withColumns({total: row_total, **shares})


def unpivot(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str, val: str
) -> DataFrame:
    return df.unpivot(list(ids), list(cols), key, val)


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


# -- statistics ------------------------------------------------------------


def correlation(
    df: DataFrame, a: str, b: str, keys: Sequence[str] = (), out: str = "correlation"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.corr(a, b).alias(out))


#: Buckets of a pass of the median selection; half of the first pass' are for either sign.
_BUCKETS = 1 << 16


def _by_size(x: Column) -> Column:
    """The bucket of a double by sign and logarithm, ascending with the number; a bucket
    spans a twentieth of its numbers' size."""
    half = _BUCKETS // 2
    steps = F.least(F.floor((F.ln(F.abs(x)) + 745) * ((half - 2) / 1456)), F.lit(half - 2))
    return F.when(x > 0, half + steps).when(x < 0, half - 2 - steps).otherwise(half - 1)


def _between(x: Column, low: float, high: float) -> Column:
    """The bucket of a double when ``low`` to ``high`` is cut evenly; ascends with the
    number, the two ends never share one."""
    return F.least(F.floor((x - low) / F.lit(high - low) * _BUCKETS), F.lit(_BUCKETS - 1))


def _places(counts: DataFrame, by: str, ranks: Mapping[int, int] | None) -> DataFrame:
    """Of ``counts (column, <by>, n, ...)`` the row of each column that holds the rank looked
    for, the lower middle one where ``ranks`` does not say, and that rank within the row."""
    whole = Window.partitionBy("column")
    upto = F.sum("n").over(whole.orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    rank = F.floor((F.sum("n").over(whole) + 1) / 2)
    if ranks is not None:
        rank = F.element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), F.col("column"))
    placed = counts.withColumns({"upto": upto, "rank": rank})
    return placed.where("upto >= rank AND upto - n < rank").withColumn("rank", F.expr("rank - upto + n"))


def median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact medians as elements of the data (the lower one of an even count), one
    row, doubles. NULL and NaN do not count.

    Radix selection: a pass counts 65,536 buckets of every column, combined before the
    shuffle, and goes on with the bucket that holds the middle row. The first pass cuts by
    sign and logarithm, each later one cuts what lies between the smallest and the largest
    value of the bucket. Once a bucket holds 65,536 rows or fewer, its values are counted
    one by one: two passes for measures as they come, at most six for any doubles. No task
    gets more than 65,536 rows of a column, and the driver sees a row per column and pass.
    """
    names = list(dict.fromkeys(cols))
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in names}
    vals = df.select(*[number[c].alias(f"c{i}") for i, c in enumerate(names)])

    def entries(buckets: Mapping[int, Column]) -> DataFrame:
        """``(column, bucket, value)`` where a bucket is not NULL; each part reads one column."""
        parts = [
            vals.select(F.lit(i).alias("column"), b.alias("bucket"), F.col(f"c{i}").alias("value")).where("bucket IS NOT NULL")
            for i, b in buckets.items()
        ]
        return reduce(DataFrame.union, parts)

    def counted(buckets: Mapping[int, Column], ranks: Mapping[int, int] | None) -> dict[int, tuple]:
        sizes = {"n": F.count(F.lit(1)), "low": F.min("value"), "high": F.max("value")}
        rows = entries({i: b.cast("int") for i, b in buckets.items()}).groupBy("column", "bucket").agg(*_named(sizes))
        return {r["column"]: (r["rank"], r["n"], r["low"], r["high"]) for r in _places(rows, "bucket", ranks).collect()}

    x = {i: F.col(f"c{i}") for i in range(len(names))}
    seen = counted({i: F.when(c.isNotNull(), _by_size(c)) for i, c in x.items()}, None)
    wide = lambda: {i: s for i, s in seen.items() if s[1] > _BUCKETS and s[2] < s[3]}
    while todo := wide():
        inside = {i: F.when(x[i].between(low, high), _between(x[i], low, high)) for i, (_, _, low, high) in todo.items()}
        seen |= counted(inside, {i: s[0] for i, s in todo.items()})
    found = {i: low for i, (_, _, low, high) in seen.items() if low == high}
    if todo := {i: s for i, s in seen.items() if i not in found}:
        inside = {i: F.when(x[i].between(low, high), F.lit(0)) for i, (_, _, low, high) in todo.items()}
        rows = entries(inside).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        found |= {r["column"]: r["value"] for r in _places(rows, "value", {i: s[0] for i, s in todo.items()}).collect()}
    result = [F.lit(found.get(names.index(c))).cast("double").alias(c) for c in cols]
    return df.sparkSession.range(1).select(*result)


# -- arrays ------------------------------------------------------------------


#: Values of an array, unless the caller says otherwise.
ARRAY_VALUES = 100_000


def implode(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    order_by: Sequence[str],
    out: str | None = None,
    chunk: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Values of each key as arrays in the order of ``order_by``.

    An array holds ``chunk`` values at most, and no value is left out: a larger group makes
    several rows, numbered from 0 by ``part``. Without ``chunk`` arrays are cut at
    ``ARRAY_VALUES`` and not numbered, so that groups of ordinary size are one row each.
    """
    out = out or col
    part = F.floor((F.col("__rn") - 1) / (chunk or ARRAY_VALUES)).cast("long")
    numbered = number_rows(df.select(*keys, *_names(order_by, keys, col), col), keys, order_by, "__rn", hot_rows)
    item = F.struct("__rn", F.col(col).alias("v"))
    arrays = (
        numbered.withColumn("part", part)
        .groupBy(*keys, "part")
        .agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias(out))
    )
    return arrays if chunk is not None else arrays.drop("part")


def _names(order: Sequence[str], *others: Sequence[str] | str) -> list[str]:
    """The sort columns that are not among the other columns, each once."""
    known = {x for other in others for x in ([other] if isinstance(other, str) else other)}
    return [o for o in dict.fromkeys(o.lstrip("-") for o in order) if o not in known]


def word_count(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """Occurrences of each word of the whole text."""
    return (
        df.select(F.explode(F.split(F.col(text), sep)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )


def _element_type(df: DataFrame, arr: str, field: str) -> T.DataType:
    element = df.schema[arr].dataType.elementType
    return element.valueType if isinstance(element, T.MapType) else element[field].dataType


def sum_nested(
    df: DataFrame, key: Sequence[str], arr: str, field: str, out: str = "total"
) -> DataFrame:
    """Sum of one field over arrays of maps or structs, per key. Each row is summed
    in place, so rows rather than elements are shuffled."""
    kind = _element_type(df, arr, field)
    wide = kind if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)) else T.LongType()
    vals = F.filter(F.transform(arr, lambda x: x[field].cast(wide)), lambda v: v.isNotNull())
    row_sum = F.when(
        F.size(vals) > 0, F.aggregate(vals, F.lit(0).cast(wide), lambda a, v: (a + v).cast(wide))
    )
    return df.where(F.size(arr) > 0).groupBy(*key).agg(F.sum(row_sum).alias(out))
