"""Ordered per-key windows that do not put a whole key into one task.

A window partitioned by key sends every row of a key to one task. When a few
keys own most of the table that task is the job. The functions here cut the
rows of such *hot* keys into slices of about equal size, evaluate the window
inside each ``(key, slice)``, and repair what crosses a slice border:

* ``bounded_window`` - frames that look a fixed number of rows back or ahead
  (previous value, next value, moving average). Only the rows next to a border
  are evaluated again, on a set that holds a few rows per slice.
* ``running_window`` - cumulative results (running sum or minimum, row number,
  ranks). Each slice is reduced to one row of totals; the totals of the earlier
  slices are added to the rows.

Whether a key is hot at all is asked first, of a sample of the key columns alone
(``has_hot_key``); where none is, the plain window is used. It gives the same rows, as
ties are settled alike, so that question too decides speed only.

Which keys are hot, and where they are cut, is read from a second sample: the rows whose
hash falls into one residue class. The sampled rows of a hot key are sorted as the
window sorts them, and every ``DEPTH``-th is the first row of a slice. A row's slice
is the number of these bounds that do not come after it, by the comparison of the
window itself, so slices are right for every type that can be sorted. The sample
decides speed only; every row goes through the window whatever the sample holds. It
is a function of the rows' values, so a task that is repeated after a lost executor
cuts exactly the same slices, and all branches of a plan agree on them.

Rows that are equal in the sort columns come in the order of their hash, in cut and
plain windows alike; rows equal in all columns are interchangeable. Where peers share
one result (ranks, RANGE frames) they also share a slice; if one sort value of a key is
itself hot, ``window`` works per distinct value instead.

Size of what is broadcast: the sample is thinned until it holds some ``SAMPLE_ROWS``
rows whatever the size of the table, and rows with sort values of over ``WIDE``
characters are no bounds. With the default ``hot_rows`` that is about 5,000 hot keys,
31,000 bounds and 36,000 rows of slice totals at most. In a table so large that the
sample is thinned, keys of more than a 5,000th of all rows are cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwork.functions.scalars import row_hash, sort_columns

#: Keys with more rows than this are cut into slices.
HOT_ROWS = 20_000_000
#: Slices cut per ``hot_rows`` rows of a hot key.
SLICES_PER_UNIT = 8
#: Sampled rows of a slice.
DEPTH = 32
#: About the most rows of the sample, however large the table.
SAMPLE_ROWS = 1_000_000
#: Sampled rows with longer sort values, as text, are no bounds.
WIDE = 512
#: The bounds of a key are searched by halves; this many halvings cover any sample.
HALVINGS = 22

#: Largest side that may be broadcast on request.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

HOT, SLICE, TIE = "__hot", "__slice", "__tie"

Build = Callable[[WindowSpec], Mapping[str, Column]]


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a side. The count reads no columns; only a side of at most ``max_rows``
    rows has its bytes added up."""
    if df.count() > max_rows:
        return False
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return (size or 0) <= max_bytes


def _sampling(hot_rows: int) -> tuple[int, int]:
    """Sampled rows of a slice, and the one row in how many that is sampled."""
    depth = max(1, min(DEPTH, hot_rows // SLICES_PER_UNIT))
    return depth, max(1, hot_rows // (SLICES_PER_UNIT * depth))


def has_hot_key(df: DataFrame, keys: Sequence[str], hot_rows: int) -> bool:
    """Whether, by a sample, a value of ``keys`` has more than ``hot_rows`` rows. Reads
    these columns once; a quarter less than ``hot_rows``, three deviations of the
    estimate, already counts."""
    _, step = _sampling(hot_rows)
    seen = df.select(*keys)
    if step > 1:
        seen = seen.sample(1.0 / step, seed=7)
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return bool(counts.where(F.col("n") * F.lit(4 * step) > 3 * hot_rows).head(1))


def measured(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> int | None:
    """``hot_rows``, or None where no key is hot: for several windows over the same keys."""
    return hot_rows if hot_rows is not None and has_hot_key(df, keys, hot_rows) else None


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """NULL-safe equality of two key lists."""
    cond = F.lit(True)
    for l, r in zip(left, right):
        cond = cond & l.eqNullSafe(r)
    return cond


def attach(
    df: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    broadcast: bool = False,
) -> DataFrame:
    """Join ``side`` (one row per key, key columns named like ``keys``) NULL-safely
    and keep its other columns. ``broadcast=True`` asks for a broadcast, which is
    granted when the side has been measured to be small."""
    if broadcast and fits_broadcast(side):
        side = F.broadcast(side)
    renamed = side.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = same_key([df[k] for k in keys], [renamed[f"__r_{k}"] for k in keys])
    return df.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def tie_column(order: Sequence[str]) -> str:
    """The row hash as a sort column, in the direction of the last one."""
    return "-" + TIE if order[-1].startswith("-") else TIE


def _runs(order: Sequence[str]) -> list[tuple[bool, list[str]]]:
    """Sort columns in runs of one direction: (descending, names)."""
    runs: list[tuple[bool, list[str]]] = []
    for o in order:
        down = o.startswith("-")
        if not runs or runs[-1][0] != down:
            runs.append((down, []))
        runs[-1][1].append(o[1:] if down else o)
    return runs


def _position(order: Sequence[str]) -> Column:
    """A row's place in the sort order: one struct for each run of a direction.
    Structs are never NULL and count a NULL field as the smallest value."""
    fields = [F.struct(*names).alias(f"r{i}") for i, (_, names) in enumerate(_runs(order))]
    return F.struct(*fields)


def _comes_before(a: Column, b: Column, order: Sequence[str]) -> Column:
    """Whether position ``a`` sorts strictly before position ``b``."""
    before = F.lit(False)
    for i, (down, _) in reversed(list(enumerate(_runs(order)))):
        x, y = a[f"r{i}"], b[f"r{i}"]
        before = (x > y if down else x < y) | ((x == y) & before)
    return before


def _sorted(positions: Column, order: Sequence[str]) -> Column:
    runs = _runs(order)
    if len(runs) == 1:
        return F.sort_array(positions, asc=not runs[0][0])
    return F.array_sort(
        positions,
        lambda a, b: F.when(_comes_before(a, b, order), -1)
        .when(_comes_before(b, a, order), 1)
        .otherwise(0),
    )


def slice_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot_rows: int,
    peers: bool = False,
) -> DataFrame:
    """Add ``__hot``, ``__slice`` and ``__tie``, the row's hash. Slices of a key ascend
    in the order of its rows, ties by hash; cold keys are one slice. With ``peers`` rows
    equal in all sort columns share a slice."""
    place = list(order) if peers else [*order, tie_column(order)]
    depth, step = _sampling(hot_rows)
    base = df.withColumn(TIE, row_hash(df))
    at = base.withColumn("__at", _position(place))

    seen = (
        at.where(F.pmod(F.col(TIE), F.lit(step)) == 0)
        .where(F.length(F.col("__at").cast("string")) <= WIDE)
        .select(*keys, "__at", TIE)
        .distinct()
    )
    # Counted over the same shuffled sample, which Spark keeps and reads again.
    thin = F.ceil(seen.agg(F.count(F.lit(1)).alias("n")).scalar() / F.lit(SAMPLE_ROWS))
    bounds = (
        seen.where(F.pmod(F.xxhash64(TIE), F.greatest(thin, F.lit(1))) == 0)
        .groupBy(*keys)
        .agg(F.collect_list("__at").alias("__bounds"))
        # A quarter less than hot_rows, three deviations of the estimate: none is missed.
        .where(F.size("__bounds") * F.lit(4 * step) > 3 * hot_rows)
        .withColumn(
            "__bounds",
            F.filter(_sorted(F.col("__bounds"), place), lambda _, i: (i > 0) & (i % depth == 0)),
        )
    )

    def search(found: Column, half: Column) -> Column:
        bound = F.get("__bounds", (found + half - 1).cast("int"))
        reached = bound.isNotNull() & ~_comes_before(F.col("__at"), bound, place)
        return F.when(reached, found + half).otherwise(found)

    halves = F.array(*[F.lit(2**i) for i in reversed(range(HALVINGS))])
    number = F.aggregate(halves, F.lit(0), search)
    return (
        attach(at, F.broadcast(bounds), keys)
        .withColumns(
            {
                HOT: F.col("__bounds").isNotNull(),
                SLICE: F.when(F.col("__bounds").isNotNull(), number).otherwise(0),
            }
        )
        .drop("__at", "__bounds")
    )


#: Sampled rows that stand for the first n of a group, and how many more are allowed for.
FIRST_DEPTH, FIRST_MARGIN = 64, 1.5


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, hot_rows: int
) -> DataFrame:
    """``df``, which holds ``__tie``, without rows of hot keys that cannot be among the first
    ``n`` in ``order``. In a sample of one row in n / 64, the 96th of a hot key lies about
    1.5 n rows into it; rows behind that one go. The rows before it are counted, and a key
    that has fewer than ``n`` of them keeps all its rows."""
    _, step = _sampling(hot_rows)
    hot = (
        df.where(F.pmod(F.col(TIE), F.lit(step)) == 0)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") * F.lit(4 * step) > 3 * hot_rows)
        .orderBy(F.desc("__n"))
        .limit(SAMPLE_ROWS // 256)
        .select(*keys, F.lit(True).alias(HOT))
    )
    at = df.withColumn("__at", _position(order))
    place = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    thin = max(1, n // FIRST_DEPTH)
    sampled = attach(at.where(F.pmod(F.xxhash64(TIE), F.lit(thin)) == 0), F.broadcast(hot), keys, "inner")
    bound = (
        sampled.withColumn("__rn", F.row_number().over(place))
        .where(F.col("__rn") <= math.ceil(FIRST_MARGIN * n / thin))
        .where(F.length(F.col("__at").cast("string")) <= WIDE)
        .groupBy(*keys)
        .agg(F.max("__rn").alias("__rn"), F.max_by("__at", "__rn").alias("__bound"))
        .where(F.col("__rn") >= n / thin)
        .drop("__rn")
    )
    bounded = attach(at, F.broadcast(bound), keys)
    near = ~_comes_before(F.col("__bound"), F.col("__at"), order)
    enough = (
        bounded.where(F.col("__bound").isNotNull() & near)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") >= n)
        .select(*keys, F.lit(True).alias("__enough"))
    )
    kept = attach(bounded, F.broadcast(enough), keys).where(F.col("__enough").isNull() | near)
    return kept.drop("__at", "__bound", "__enough")


def bounded_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Build,
    reach: int,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Evaluate ``build(window)`` where no frame looks further than ``reach`` rows.

    ``hot_rows=None`` is the plain window, for inputs known to have small groups; the
    rows are the same. Select the columns you need before: all of them are read to
    settle ties.
    """
    sort = sort_columns([*order, tie_column(order)])
    whole = Window.partitionBy(*keys).orderBy(*sort)
    if measured(df, keys, hot_rows) is None:
        return df.withColumn(TIE, row_hash(df)).withColumns(build(whole)).drop(TIE)

    sliced = slice_hot_keys(df, keys, order, hot_rows)
    part = Window.partitionBy(*keys, SLICE).orderBy(*sort)

    def near(n: int) -> Column:
        one = F.lit(1)
        return F.lag(one, n).over(part).isNull() | F.lead(one, n).over(part).isNull()

    names = list(build(whole))
    settled = (
        sliced.withColumns({**build(part), "__redo": near(reach)})
        .where(~(F.col(HOT) & F.col("__redo")))
        .select(*df.columns, *names)
    )
    redone = (
        sliced.where(F.col(HOT))
        .withColumns({"__redo": near(reach), "__context": near(2 * reach)})
        .where(F.col("__context"))
        .withColumns(build(whole))
        .where(F.col("__redo"))
        .select(*df.columns, *names)
    )
    return settled.unionByName(redone)


def running_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    local: Build,
    totals: Mapping[str, Column],
    before: Build,
    combine: Mapping[str, Column],
    hot_rows: int | None = HOT_ROWS,
    peers: bool = False,
) -> DataFrame:
    """Cumulative window in three steps.

    ``local(w)``   columns evaluated inside a (key, slice);
    ``totals``     aggregates that reduce a slice to one row (may use local columns);
    ``before(w)``  columns over the slices of a key, in order, ``w`` having no frame;
    ``combine``    final columns from local and ``before`` columns. The latter are
                   NULL for cold keys, which have a single slice;
    ``peers``      whether rows equal in all sort columns get one result.
    """
    sort = sort_columns(order if peers else [*order, tie_column(order)])
    final = [c.alias(n) for n, c in combine.items()]
    keep = [c for c in df.columns if c not in combine]
    carry = before(Window.partitionBy(*keys).orderBy(SLICE))

    def add_local(frame: DataFrame, w: WindowSpec) -> DataFrame:
        # One at a time: a local column may build on an earlier one.
        for name, column in local(w).items():
            frame = frame.withColumn(name, column)
        return frame

    if measured(df, keys, hot_rows) is None:
        plain = df if peers else df.withColumn(TIE, row_hash(df))
        single = add_local(plain, Window.partitionBy(*keys).orderBy(*sort))
        return single.withColumns({n: F.lit(None) for n in carry}).select(*keep, *final)

    sliced = slice_hot_keys(df, keys, order, hot_rows, peers)
    part = Window.partitionBy(*keys, SLICE).orderBy(*sort)
    carried = (
        add_local(sliced.where(F.col(HOT)), part)
        .groupBy(*keys, SLICE)
        .agg(*[c.alias(n) for n, c in totals.items()])
    )
    for name, column in carry.items():
        carried = carried.withColumn(name, column)
    carried = carried.select(*keys, SLICE, *carry)
    joined = attach(add_local(sliced, part), F.broadcast(carried), [*keys, SLICE])
    return joined.select(*keep, *final)
