"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical without white space. Each level looks
only at rows that the level before could not tell apart:

1. rows are counted by length; a length that occurs once ends the search;
2. the others are counted by a hash of length and prefix;
3. only rows that are still not alone get a hash of their whole content and are
   grouped by it.

Length and prefix hash of all rows are written once, and both levels are counted
there, without texts. What goes on is kept as bucket numbers that can be broadcast:
lengths as a set of at most ``BUCKETS`` numbers, prefix hashes as bitmaps with
``ROOM`` buckets for every row, up to ``MOST_BUCKETS`` (64 MB) and so to 134 million
rows. Above that buckets fill up, and at some billions of rows the prefix hash rules
out little. A bucket with one row proves the row to be alone; a bucket with more
proves nothing and the row goes on, so few buckets cost time, never a duplicate.
Texts don't move for the first two levels; rows that are alone never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import GAP, stored, text_or_empty

BUCKETS = 1 << 20
ROOM = 4
MOST_BUCKETS = 1 << 29
PREFIX = 256
# Fixed value: the bits of one of Spark's bitmaps
BITMAP = 1 << 15


def normalised(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, GAP, "")


def prefix_buckets(rows: int) -> int:
    """How many buckets the prefix hashes of so many rows are dealt over."""
    wanted = 1 << (ROOM * max(rows, 1) - 1).bit_length()
    return max(BUCKETS, min(MOST_BUCKETS, wanted))


def _levels(docs: DataFrame, text: str, doc_id: str, buckets: int | None,
            prefix: int) -> tuple[DataFrame, DataFrame]:
    """Rows that are alone by length or prefix, and the others with their full hash."""
    keyed = (docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"),
                         F.char_length(text_or_empty(text)).alias("n"),
                         normalised(text_or_empty(text)).alias("norm"))
             .withColumn("len", F.char_length("norm")))
    begin = F.xxhash64("len", F.substring("norm", 1, prefix))
    levels = stored(keyed.select(F.pmod("len", F.lit(buckets or BUCKETS)).alias("length"),
                                 begin.alias("begin")), "levels")
    buckets = buckets or prefix_buckets(levels.count())
    bucket = F.pmod("begin", F.lit(buckets).cast("long"))

    same_length = (levels.groupBy(F.col("length").alias("same")).count().where("count > 1")
                   .select("same"))  # at most BUCKETS numbers
    shared = (levels.join(F.broadcast(same_length), F.col("length") == F.col("same"), "left_semi")
              .groupBy(bucket.alias("b")).count().where("count > 1")
              .select(F.floor(F.col("b") / BITMAP).alias("block"),
                      (F.col("b") % BITMAP).alias("at")))
    # dealt by block first: else every task would move bitmaps of nearly all blocks
    same_begin = stored(shared.repartition("block").groupBy("block")
                        .agg(F.bitmap_construct_agg("at").alias("bits")), "same-begin")

    # null-safe, as the optimizer would else test every text for null
    probed = keyed.withColumn("begin", begin).withColumn("b", bucket)
    probed = probed.join(F.broadcast(same_begin),  # at most MOST_BUCKETS / 8 bytes
                         F.floor(F.col("b") / BITMAP).eqNullSafe(F.col("block")), "left")
    at = F.col("b") % BITMAP
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    met = F.coalesce(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1, F.lit(False))
    kept = ["row", "id", "n", "len"]
    return (probed.where(~met).select(*kept),
            probed.where(met).select(*kept, F.sha2("norm", 256).alias("full")))


def _rank() -> list[Column]:
    """The row that stays is the least: most code points, then smallest id, null last."""
    return [(-F.col("n")).alias("shorter"), F.col("id").isNull().alias("nameless"), F.col("id")]


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 buckets: int | None = None, prefix: int = PREFIX) -> DataFrame:
    """Per row: ``row`` (all its columns), ``keep_id``, ``group_size``, ``kept``.

    Null text counts as empty, and all empty texts are equal. Of equal texts the
    one with the most code points stays, then the smallest id; a null id comes
    last. Rows that repeat id and text of the row that stays are that same
    document and marked kept as well (``exact_dedup`` returns them once). An empty
    table gives an empty result; other columns are carried in ``row``. ``buckets``
    sets the number of buckets of both levels, which else follows from the rows.
    """
    alone, suspects = _levels(docs, text, doc_id, buckets, prefix)
    best = (suspects.groupBy("len", "full")
            .agg(F.min(F.struct(*_rank())).alias("best"), F.count("*").alias("size"))
            .withColumnsRenamed({"len": "best_len", "full": "best_full"}))
    found = suspects.join(best, F.col("full").eqNullSafe(F.col("best_full"))
                          & F.col("len").eqNullSafe(F.col("best_len")))
    stays = (-F.col("n") == F.col("best.shorter")) & F.col("id").eqNullSafe(F.col("best.id"))
    return (alone.select("row", F.col("id").alias("keep_id"),
                         F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
            .union(found.select("row", "best.id", "size", stays)))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                buckets: int | None = None, prefix: int = PREFIX) -> DataFrame:
    """The documents without exact copies, each group once, columns as they were.

    Rows that repeat the kept row's id are reduced to the one with the least hash
    over all columns.
    """
    alone, suspects = _levels(docs, text, doc_id, buckets, prefix)
    # copies are reduced before they move: a row per group and task
    first = (suspects.groupBy("len", "full")
             .agg(F.min_by("row", F.struct(*_rank(), F.xxhash64("row"))).alias("row")))
    return alone.select("row.*").union(first.select("row.*"))
