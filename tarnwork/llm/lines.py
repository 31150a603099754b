"""Lines that many documents share, by a sorted stream of line hashes; DataFrame functions only.

The key of a line is the line without white space (the six ASCII characters) at both ends,
A-Z in lower case. Keys of at least ``least`` code points that ``documents`` or more ids hold
lose all their lines but those of the largest id.

1. Every long line becomes a row ``(id, tag, line, hash)``: 16 bytes of MD5 in place of text.
2. The rows are partitioned by ranges of the hash, sorted by hash, then id (largest first) and
   position, and streamed: the first row of a hash names the id that keeps it, changes of id
   count the documents.
3. A hash that owns more than a 2,048th of a sample is cut into slices by a hash of the id, which are
   ranges of their own. There are fewer than 2,048 such hashes whatever the input, so that one
   row for each can be sent to all tasks to put the slices together.
4. What comes back is, per document, the keep bitmap in words of 64 lines. Only words that
   drop a line are held, in order; all others keep every line.

``tag`` tells rows of one id apart by a hash of their text. Rows that share an id are one
document in the counts, each with a bitmap of its own; equal rows share one. Rows without an
id are one document, smaller than any other. A null text is an empty one: one empty line.
Ids can be of any type that can be sorted. Columns of ``docs`` other than id and text are not
read, so their names cannot clash, but for the three columns that ``without_repeats`` adds,
which replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch

#: Slices that one range of all rows, a 2,048th, may not exceed, and rows always left whole.
PARTS = 2048
WHOLE = 256
#: Rows of the sample that finds hot hashes, about.
SAMPLED = 1 << 20

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lower(text: Column) -> Column:
    """A-Z in lower case; ``lower`` does that where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def long_lines(docs: DataFrame, least: int, id_column: str, text_column: str) -> DataFrame:
    """``(id, tag, line, hash)`` of the lines whose key has ``least`` code points or more."""
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("tag"), F.posexplode(lines_of(text)).alias("line", "body"))
    rows = rows.withColumn("body", F.btrim("body", F.lit(_SPACE))).where(F.char_length("body") >= least)
    return rows.select("id", "tag", "line", F.unhex(F.md5(_lower(F.col("body")).cast("binary"))).alias("hash"))


def _hot(rows: DataFrame, total: int) -> DataFrame:
    """``(hot, slices)`` of hashes that own more than a 2,048th of a sample of the rows."""
    step = max(1, total // SAMPLED)
    chosen = rows.where(F.pmod(F.xxhash64("id", "tag", "line"), F.lit(step)) == 0).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    most = max(WHOLE, total // PARTS) / step
    hot = chosen.where(F.col("n") > most)
    return hot.select(F.col("hash").alias("hot"), F.ceil(F.col("n") / F.lit(most)).alias("slices"))


def dropped_lines(
    docs: DataFrame,
    spark: SparkSession,
    least: int = 40,
    documents: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, tag, line)`` of the lines to leave out."""
    scratch = Scratch(spark, "lines")
    rows = scratch.save(long_lines(docs, least, id_column, text_column), "rows")
    hot = scratch.save(_hot(rows, rows.count()), "hot")
    rows = rows.join(F.broadcast(hot), F.col("hash") == F.col("hot"), "left").drop("hot")
    rows = rows.withColumn("slices", F.coalesce("slices", F.lit(1).cast("long")))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")))

    order = [F.desc_nulls_last("id"), F.asc("tag"), F.asc("line")]
    ranged = rows.repartitionByRange("hash", "slice").sortWithinPartitions("hash", "slice", *order)
    stream = Window.partitionBy("hash", "slice").orderBy(*order)
    own = stream.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag(F.struct("id")).over(stream)
    seen = ranged.withColumn("new", (before.isNull() | ~before["id"].eqNullSafe(F.col("id"))).cast("long"))
    seen = seen.withColumns(
        {
            "first": F.row_number().over(stream) == 1,
            "chief": F.first("id").over(stream),
            "held": F.sum("new").over(own),
        }
    )
    kept = (F.col("held") >= documents) & ~F.col("id").eqNullSafe(F.col("chief"))
    found = scratch.save(
        seen.where((F.col("slices") > 1) | kept).select("id", "tag", "line", "hash", "slices", "first", "chief", "held"), "found"
    )
    split = found.where("slices > 1")
    whole = split.where("first").groupBy(F.col("hash").alias("of")).agg(F.max("chief").alias("top"), F.sum("held").alias("all"))
    rejoined = split.join(F.broadcast(whole.where(F.col("all") >= documents)), F.col("hash") == F.col("of"))
    rejoined = rejoined.where(~F.col("id").eqNullSafe(F.col("top")))
    return found.where("slices = 1").select("id", "tag", "line").unionByName(rejoined.select("id", "tag", "line"))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """``(id, tag, keep, n_dropped)`` of documents that lose lines; ``keep`` lists words of
    64 lines, bit 0 the first, that have a line to drop."""
    bit = F.expr("shiftleft(1L, line % 64)")
    words = dropped.groupBy("id", "tag", F.expr("line div 64").alias("word")).agg(F.bit_or(bit).alias("gone"))
    one = F.struct(F.col("word"), F.bitwise_not("gone").alias("bits"))
    return words.groupBy("id", "tag").agg(
        F.array_sort(F.collect_list(one)).alias("keep"), F.sum(F.bit_count("gone")).cast("long").alias("n_dropped")
    )


def dropped_of(keep: Column) -> Column:
    """The numbers of the lines that a keep bitmap leaves out, in order."""
    places = F.sequence(F.lit(0), F.lit(63))
    lost = lambda w: F.filter(places, lambda b: F.getbit(w["bits"], b) == 0)
    return F.flatten(F.transform(keep, lambda w: F.transform(lost(w), lambda b: w["word"] * 64 + b)))


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` but those numbered ``gone``: the stretches between them."""
    def stretch(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(gone, i - 1) + 1)
        end = F.coalesce(F.get(gone, i), F.size(lines).cast("long"))
        return F.slice(lines, (start + 1).cast("int"), (end - start).cast("int"))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))


def without_repeats(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text that is left."""
    added = ["n_lines", "n_dropped", "kept"]
    own = docs.drop(*added)
    side = bitmaps.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), F.struct("n_dropped", "keep").alias("__map"))
    same = own[id_column].eqNullSafe(F.col("__id")) & (F.xxhash64(own[text_column]) == F.col("__tag"))
    rows = own.join(side, same, "left")
    text = F.coalesce(own[text_column], F.lit(""))
    lines = lines_of(own[text_column])
    rest = F.array_join(_without(F.col("__lines"), F.col("__gone")), "\n")
    rows = rows.withColumns({"__lines": lines, "__gone": dropped_of(F.col("__map.keep"))})
    return rows.withColumns(
        {
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": F.coalesce("__map.n_dropped", F.lit(0).cast("long")),
            "kept": F.when(F.col("__map").isNull(), text).otherwise(rest),
        }
    ).select(*own.columns, *added)


def bitmaps(
    docs: DataFrame,
    spark: SparkSession,
    least: int = 40,
    documents: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Keep bitmaps of all documents that lose lines."""
    return keep_bitmaps(dropped_lines(docs, spark, least, documents, id_column, text_column))
