"""Joins. Skewed equi-joins rely on adaptive skew splitting unless stated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.scalars import row_hash
from tarnwork.operators.project import prefix_columns
from tarnwork.operators.skew import HOT_ROWS, attach, fits_broadcast, has_hot_key

#: Rows of a pack of the right side of a cross join.
CROSS_ROWS = 1_000
#: Hot keys that a full outer join lays out as grids, the hottest first.
GRID_KEYS = 20_000

On = str | Sequence[str] | Mapping[str, str] | Column


def join(l: DataFrame, r: DataFrame, on: On, how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Equi-join on shared names (one key column in the result), on differently
    named columns (``{left: right}``, both kept), or on a predicate.

    ``broadcast=True`` asks for a broadcast of the right side; it is measured
    first, and a side over the limits is joined by shuffle instead.
    """
    right = F.broadcast(r) if broadcast and fits_broadcast(r) else r
    if isinstance(on, Mapping):
        cond = F.lit(True)
        for a, b in on.items():
            cond = cond & (l[a] == r[b])
        return l.join(right, cond, how)
    if isinstance(on, (str, Column)):
        return l.join(right, on, how)
    return l.join(right, list(on), how)


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(on, Mapping):
        return dict(on)
    return {k: k for k in ([on] if isinstance(on, str) else on)}


def unmatched(
    l: DataFrame, r: DataFrame, on: str | Sequence[str] | Mapping[str, str], via: str = "anti"
) -> DataFrame:
    """Rows of ``l`` without a partner in ``r``. The right side is reduced to its
    distinct keys before the shuffle, so a key repeated there costs nothing.
    ``via="outer"`` takes the long way over an outer join and a NULL test."""
    pairs = _pairs(on)
    right = r.select(*[F.col(b).alias(f"__r_{b}") for b in pairs.values()]).distinct()
    cond = F.lit(True)
    for a, b in pairs.items():
        cond = cond & (l[a] == F.col(f"__r_{b}"))
    if via == "anti":
        return l.join(right, cond, "left_anti")
    first = next(iter(pairs.values()))
    return l.join(right, cond, "left").where(F.col(f"__r_{first}").isNull()).drop(*right.columns)


def _presence(l: DataFrame, r: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Keys with the rows they have on either side, ``__nl`` and ``__nr``."""
    names = [f"k{i}" for i in range(len(pairs))]
    left = l.select(*[F.col(a).alias(n) for a, n in zip(pairs, names)], F.lit(1).alias("__l"), F.lit(0).alias("__r"))
    right = r.select(*[F.col(b).alias(n) for b, n in zip(pairs.values(), names)], F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    return left.union(right).groupBy(*names).agg(F.sum("__l").alias("__nl"), F.sum("__r").alias("__nr"))


def full_join(
    l: DataFrame,
    r: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    split: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Full outer join on shared names (one key column), or on differently named
    columns (both kept). Other columns must not share names; prefix them.

    The adaptive planner cannot split either side of a full outer join where a key
    is hot. With ``split`` the keys of both sides are sampled; if one is hot, the rows of
    all keys are counted, from the key columns alone. A key of more than ``hot_rows`` rows is laid out as a grid: its left rows
    in as many strips as they need, its right rows in columns, each row repeated for the
    strips that cross its own, so that every pair meets in one cell. Rows of a key that is
    on both sides have a partner somewhere; what a cell with an empty strip says about
    them is left out. NULL keys, which meet nobody, are strips of their own side. So each
    side is read twice and joined once. ``split=False`` is the plain join.
    """
    pairs = _pairs(on)
    hot = split and (has_hot_key(l, list(pairs), hot_rows) or has_hot_key(r, list(pairs.values()), hot_rows))
    if not hot:
        return join(l, r, on, "full")
    names = [f"k{i}" for i in range(len(pairs))]
    null = F.lit(False)
    for n in names:
        null = null | F.col(n).isNull()
    strips = lambda n: F.greatest(F.ceil(F.col(n) / F.lit(hot_rows)), F.lit(1)).cast("int")
    met = (F.col("__nl") > 0) & (F.col("__nr") > 0) & ~null
    grids = (
        _presence(l, r, pairs)
        .where(F.greatest("__nl", "__nr") > hot_rows)
        .orderBy(F.greatest("__nl", "__nr").desc())
        .limit(GRID_KEYS)
        .select(*names, F.struct(strips("__nl").alias("l"), strips("__nr").alias("r"), met.alias("met")).alias("__grid"))
    )

    def laid(side: DataFrame, keys: Sequence[str], own: str, other: str, mark: str) -> DataFrame:
        grid = attach(side, F.broadcast(grids.withColumnsRenamed(dict(zip(names, keys)))), keys)
        spread = F.pmod(row_hash(side), F.lit(1 << 30)) + F.spark_partition_id()
        strip = F.when(F.col("__grid").isNull(), 0).otherwise(F.pmod(spread, F.col(f"__grid.{own}"))).cast("int")
        crossing = F.when(F.col("__grid.met"), F.sequence(F.lit(0), F.col(f"__grid.{other}") - 1)).otherwise(F.array(F.lit(0)))
        both = F.coalesce("__grid.met", F.lit(False))
        rows = grid.withColumns({f"__{own}": strip, mark: both}).withColumn(f"__{other}", F.explode(crossing))
        return rows.drop("__grid")

    left = laid(l, list(pairs), "l", "r", "__left")
    right = laid(r, list(pairs.values()), "r", "l", "__right")
    if isinstance(on, Mapping):
        # Cells are compared under other names: the right side's would clash.
        right = right.withColumnsRenamed({"__l": "__l2", "__r": "__r2"})
        cond = (F.col("__l") == F.col("__l2")) & (F.col("__r") == F.col("__r2"))
        for a, b in pairs.items():
            cond = cond & (left[a] == right[b])
        joined = left.join(right, cond, "full").drop("__l2", "__r2")
    else:
        joined = left.join(right, [*pairs, "__l", "__r"], "full")
    alone = F.col("__left").isNull() | F.col("__right").isNull()
    spurious = alone & (F.coalesce("__left", F.lit(False)) | F.coalesce("__right", F.lit(False)))
    return joined.where(~spurious).drop("__l", "__r", "__left", "__right")


def reconcile(
    l: DataFrame,
    r: DataFrame,
    key: str,
    lp: str,
    rp: str,
    defaults: Mapping[str, object],
) -> DataFrame:
    """Full outer join of two prefixed tables with a default per column."""
    both = full_join(prefix_columns(l, lp), prefix_columns(r, rp), {lp + key: rp + key})
    return both.na.fill(dict(defaults))


def cross(l: DataFrame, r: DataFrame, pack: int = CROSS_ROWS) -> DataFrame:
    """Every row of ``l`` with every row of ``r``. The right side becomes packs of at most
    ``pack`` rows, one array each. One pack, the usual case, is sent to all tasks and
    exploded in place. Several make a grid: left rows are dealt to lanes and sent to every
    pack, each pack to every lane, and a task holds one pack at a time."""
    columns = F.struct(*r.columns)
    rows = r.count()
    if rows <= pack:
        packed = r.agg(F.collect_list(columns).alias("rows")).scalar()
        return l.withColumn("__r", F.explode(packed)).select(*l.columns, "__r.*")
    # As many cells as there are shuffle partitions, so that no task gets all left rows.
    tasks = int(l.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, tasks * pack // rows)
    packs = (
        r.withColumn("__pack", F.expr(f"monotonically_increasing_id() div {int(pack)}"))
        .groupBy("__pack")
        .agg(F.collect_list(columns).alias("__rows"))
    )
    numbers = packs.agg(F.collect_list("__pack").alias("n")).scalar()
    lane = F.pmod(F.monotonically_increasing_id(), F.lit(lanes))
    left = l.withColumn("__lane", lane).withColumn("__pack", F.explode(numbers))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))
    met = left.join(packs.withColumn("__lane", every), ["__pack", "__lane"])
    return met.withColumn("__r", F.explode("__rows")).select(*l.columns, "__r.*")


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, n_salts: int, how: str = "left"
) -> DataFrame:
    """Join on (key, salt): the rows of one key are spread over ``n_salts`` groups
    and the dimension is repeated once per salt. Equals the plain join.

    The salt mixes the row's hash with the number of its input task. Equal rows
    from different tasks are spread too, and a repeated task draws the same salts.
    Dimension rows without facts, which right and full joins keep, are found on the
    plain dimension, where each stands once.
    """
    if how in ("right", "full"):
        matched = salted_join(fact, dim, key, n_salts, "inner" if how == "right" else "left")
        alone = dim.join(fact.select(key).distinct(), key, "left_anti")
        return matched.unionByName(alone, allowMissingColumns=True)
    spread = F.pmod(row_hash(fact), F.lit(n_salts)) + F.spark_partition_id()
    salted = fact.withColumn("__salt", F.pmod(spread, F.lit(n_salts)).cast("int"))
    repeated = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))))
    return salted.join(repeated, [key, "__salt"], how).drop("__salt")


def resolve_parent(
    df: DataFrame, id_col: str, parent_id: str, name: str, out: str = "parent_name"
) -> DataFrame:
    """The name behind ``parent_id``; rows without a parent are kept with NULL."""
    parents = df.select(F.col(id_col).alias("__pid"), F.col(name).alias(out))
    return df.join(parents, df[parent_id] == F.col("__pid"), "left").drop("__pid")


def join_current(
    dim: DataFrame, fact: DataFrame, on: Mapping[str, str], end: str = "__END_AT"
) -> DataFrame:
    """Open versions of a type 2 dimension, each with its facts if any."""
    return join(dim.where(F.col(end).isNull()), fact, on, "left")
