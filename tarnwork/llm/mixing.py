"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's share is its part of all tokens (words). Weights are the shares raised to an
exponent and normalised; 1 leaves the shares, 0 makes them equal. The exponent is bisected:
the smallest one in [0, 1] at which the entropy of the weights is no more than
``entropy`` times its maximum and no source is repeated more than ``repeats`` times.

The weights are realised for a budget of tokens. A source gets whole epochs and one part
epoch. Its documents are in blocks by hash; every epoch visits the blocks in an order of its
own, and the documents of a block in an order of their own. The part epoch takes blocks while
the budget lasts and, of the block where it ends, documents while it lasts. Only block totals
are added up in order, per source, and the documents of that one block; so a source with a
third of all rows is spread over tasks like any other, and the rows selected follow from four
numbers per source, without a shuffle of the texts.

``mix_block`` and ``mix_order`` arrange the result: the sources advance in proportion, so each
mix block holds all of them by weight.

A null source is a source of its own. A null or empty text has no tokens; it is taken with
its block and costs nothing. A source without any token has weight 0 and is left out. Rows
equal in id and text are taken or left together, so that a source can end above its quota by
such rows, and otherwise ends below it by less than a document. Where even the shares
themselves break the limit on repeats, quotas are cut to the limit and the budget is not met.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import WORD, Scratch

#: Exponents tried at a time: five bisection steps in one pass over the sources.
TRIED = 32
ROUNDS = 6
#: Documents per block, at most and on average; half of that at least.
BLOCK_DOCS = 2048


def tokens_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _tried(sources: DataFrame, low: float, high: float, budget: float) -> list[tuple[float, float, float]]:
    """``(exponent, entropy, most repeats)`` for evenly spaced exponents."""
    grid = [low + (high - low) * i / TRIED for i in range(TRIED + 1)]
    a = F.col("exponent")
    raised = sources.where("tokens > 0").withColumn("exponent", F.explode(F.array(*map(F.lit, grid))))
    raised = raised.withColumn("r", F.pow("share", a))
    sums = raised.groupBy("exponent").agg(
        F.sum("r").alias("z"), F.sum(F.col("r") * F.log("r")).alias("s"), F.max(F.col("r") / F.col("tokens")).alias("m")
    )
    rows = sums.select("exponent", F.log("z") - F.col("s") / F.col("z"), F.col("m") * budget / F.col("z")).collect()
    return sorted(map(tuple, rows))


def bisect_exponent(sources: DataFrame, budget: float, entropy: float | None, repeats: float | None) -> float:
    """The smallest exponent that meets both targets; 1 where none below does."""
    count = sources.where("tokens > 0").count()
    most = math.log(count) * entropy if entropy is not None and count else math.inf
    limit = math.inf if repeats is None else repeats
    low, high = 0.0, 1.0
    if not count:
        return 1.0
    for _ in range(ROUNDS):
        fits = [(a, h <= most + 1e-12 and m <= limit + 1e-12) for a, h, m in _tried(sources, low, high, budget)]
        if fits[0][1]:
            return fits[0][0]
        at = next((i for i, (_, ok) in enumerate(fits) if ok), len(fits) - 1)
        low, high = fits[at - 1][0], fits[at][0]
    return high


def _documents(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(source_column).alias("source"),
        F.struct(F.col(id_column), F.xxhash64(text_column)).alias("key"),
        tokens_of(text_column).alias("tokens"),
    )


def _power_of_two(least: Column) -> Column:
    """The smallest power of two that is ``least`` or more."""
    digits = F.length(F.bin(least.cast("long") - 1))
    return F.when(least <= 1, F.lit(1).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), digits))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _block_order(seed: int, epoch: Column, source: Column, block: Column, blocks: Column) -> Column:
    """Place of a block in an epoch: an odd multiple plus a shift permutes the numbers
    below a power of two."""
    last = blocks - 1
    times = F.xxhash64(F.lit(seed + 2), epoch, source).bitwiseAND(last).bitwiseOR(F.lit(1).cast("long"))
    shift = F.xxhash64(F.lit(seed + 3), epoch, source).bitwiseAND(last)
    return (times * block + shift).bitwiseAND(last)


def _order(seed: int, epoch: Column, key: Column) -> Column:
    return F.xxhash64(F.lit(seed + 1), epoch, key)


def plan(
    docs: DataFrame,
    spark: SparkSession,
    budget: int | None = None,
    entropy: float | None = 0.9,
    repeats: float | None = 4.0,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per source: ``tokens, documents, share, weight, quota, blocks, full`` (whole
    epochs) and where the part epoch ends: ``end_block`` (place in the order of blocks) and
    ``end_order`` (last document of that block). ``budget`` is all tokens by default."""
    scratch = Scratch(spark, "mixing")
    sized = scratch.save(_documents(docs, id_column, text_column, source_column), "sized")
    sources = sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    sources = scratch.save(sources.withColumn("blocks", _power_of_two(F.ceil(F.col("documents") / BLOCK_DOCS))), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    shared = sources.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    exponent = bisect_exponent(shared, float(budget), entropy, repeats)
    raised = shared.withColumn("raised", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    z = raised.agg(F.sum("raised")).first()[0] or 1.0
    quota = F.round(F.col("weight") * F.lit(float(budget))).cast("long")
    if repeats is not None:
        quota = F.least(quota, F.floor(F.col("tokens") * F.lit(float(repeats))))
    weighted = raised.withColumn("weight", F.col("raised") / F.lit(z)).withColumn("quota", quota)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    weighted = weighted.withColumns({"exponent": F.lit(exponent), "full": full})
    weighted = scratch.save(weighted.withColumn("rest", F.col("quota") - F.col("full") * F.col("tokens")), "weighted")

    settings = weighted.select(F.col("source").alias("of"), "blocks", "full", "rest", "weight")
    joined = sized.join(settings, F.col("source").eqNullSafe(F.col("of")) & (F.col("weight") > 0))
    placed = joined.withColumn("block", _block(F.col("key"), F.col("blocks")))
    placed = placed.withColumn("at", _block_order(seed, F.col("full"), F.col("source"), F.col("block"), F.col("blocks")))
    totals = placed.groupBy("source", "at", "rest").agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy("source").orderBy("at")
    ends = (
        totals.withColumn("after", F.sum("n").over(upto))
        .withColumn("left", F.col("rest") - F.col("after") + F.col("n"))
        .where("rest > 0 AND after > rest AND left >= 0")
        .groupBy("source")
        .agg(F.min_by(F.struct("at", "left"), "at").alias("end"))
        .select(F.col("source").alias("of2"), F.col("end.at").alias("end_block"), F.col("end.left").alias("left"))
    )
    ends = scratch.save(ends, "ends")
    last = placed.join(ends, F.col("source").eqNullSafe(F.col("of2")) & (F.col("at") == F.col("end_block")))
    last = last.withColumn("order", _order(seed, F.col("full"), F.col("key")))
    within = Window.partitionBy("source").orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("n", F.sum("tokens").over(within)).where("n <= left")
    last = last.groupBy("source").agg(F.max("order").alias("end_order")).withColumnRenamed("source", "of3")
    made = weighted.join(ends, F.col("source").eqNullSafe(F.col("of2")), "left")
    made = made.join(last, F.col("source").eqNullSafe(F.col("of3")), "left").drop("of2", "of3", "left", "raised")
    return scratch.save(made.withColumn("seed", F.lit(seed)), "plan")


def mix(
    docs: DataFrame,
    planned: DataFrame,
    mix_blocks: int = 64,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as ``planned`` takes them, with ``n_tokens``,
    ``epoch``, ``mix_block`` and ``mix_order``; columns of these names are replaced."""
    seed = planned.first()
    seed = 0 if seed is None else seed["seed"]
    one = F.struct("full", "blocks", "tokens", "quota", "end_block", "end_order")
    side = planned.where("weight > 0").select(F.col("source").alias("__source"), one.alias("__plan"))
    added = ["n_tokens", "epoch", "mix_block", "mix_order"]
    own = docs.drop(*added)
    key = F.struct(F.col(id_column), F.xxhash64(text_column))
    rows = own.join(side, own[source_column].eqNullSafe(F.col("__source")))
    p = lambda name: F.col(f"__plan.{name}")
    block = _block(key, p("blocks"))
    place = lambda epoch: _block_order(seed, epoch, F.col(source_column), block, p("blocks"))
    here = place(p("full"))
    # A source without an end has no part epoch.
    part = (here < p("end_block")) | (
        (here == p("end_block")) & (_order(seed, p("full"), key) <= p("end_order"))
    )
    epochs = p("full") + F.coalesce(part, F.lit(False)).cast("long")
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("__epochs", epochs).where("__epochs > 0")
    rows = rows.withColumn("epoch", F.explode(F.sequence(zero, F.col("__epochs") - 1)))
    turns = p("quota") / p("tokens")
    order = _order(seed, F.col("epoch"), key)
    within = (place(F.col("epoch")) + order / F.lit(2.0**64) + 0.5) / p("blocks")
    share = (F.col("epoch") + within) / F.greatest(turns, F.lit(1e-300))
    return rows.withColumns(
        {
            "n_tokens": tokens_of(text_column),
            "mix_block": F.least(F.floor(share * mix_blocks), F.lit(mix_blocks - 1)).cast("int"),
            "mix_order": order,
        }
    ).select(*own.columns, *added)
