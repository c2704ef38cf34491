"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Documents are dealt into shards and, within a shard, each source's documents are
laid end to end in a seeded order: a line that is cut into blocks of ``block``
words. The shard's blocks are awarded to its sources one after the other by the
highest quotient target / (2 * awarded + 1), which gives whole quotas. A quota
takes its blocks' words: the line as often as it fits, and once more the line's
first words. As the order is seeded, that is a seeded choice of blocks, and only
the document at the cut is taken in part.

A quota is off by about a block, alike in every shard. So a source is dealt over
no more shards than leave it ``LEAST_BLOCKS`` blocks to take in each: however many
shards the corpus has, a source comes within a fraction of a percent of its
target, or within a few blocks if it is smaller than that.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.shared import few_rows, stored, text_or_empty, word_count

WEIGHTS = (1, 2, 3)
BLOCK = 16
SHARD_WORDS = 1 << 17
LEAST_BLOCKS = 256
MOST_SOURCES = 100_000
CELLS = 1 << 16
CELL_ROWS = 16


def cells_for(rows: int) -> int:
    """Cells that so many rows are dealt into: shards are put together from whole cells.

    They stay more than the shards as long as documents have fewer than
    ``SHARD_WORDS / CELL_ROWS`` words on average.
    """
    return max(CELLS, 1 << (max(rows, 1) // CELL_ROWS).bit_length())


def source_targets(sizes: Sequence[int], weights: Sequence[float], total: float,
                   most: float) -> list[float]:
    """Share ``total`` by weight; a target stops at ``most`` times its size.

    What stopped targets leave is shared among the others by weight, until no
    target is above its bound.
    """
    targets = [0.0] * len(sizes)
    open_, rest = list(range(len(sizes))), float(total)
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            rest -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def apportion(targets: Sequence[float], bounds: Sequence[int], seats: int) -> list[int]:
    """Sainte-Lague: each seat goes to the highest target / (2 * held + 1); ties to the first.

    No one gets more seats than its bound. The seats that every divisor method
    step above a common quotient awards are given at once, the last ones singly.
    """
    def at(quotient: float) -> list[int]:
        return [min(b, int(t / quotient + 0.5)) if t > 0 else 0
                for t, b in zip(targets, bounds, strict=True)]

    low, high = 1e-9, max([1.0, *targets]) * 4
    for _ in range(100):
        mid = (low * high) ** 0.5
        low, high = (low, mid) if sum(at(mid)) <= seats else (mid, high)
    held = at(high * (1 + 1e-9))  # above ties, which go to the first
    heap = [(-t / (2 * h + 1), i) for i, (t, h, b) in
            enumerate(zip(targets, held, bounds, strict=True)) if t > 0 and h < b]
    heapq.heapify(heap)
    for _ in range(seats - sum(held)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        held[i] += 1
        if held[i] < bounds[i]:
            heapq.heappush(heap, (-targets[i] / (2 * held[i] + 1), i))
    return held


def _quotas(block: int, most: int):
    def of(cells: pd.DataFrame) -> pd.DataFrame:
        """Quotas of one shard; it has one row per source."""
        cells = cells.sort_values("source", na_position="last", kind="stable")
        blocks = -(-cells["cell"] // block)
        seats = int(cells["goal"].sum() / block + 0.5)
        quota = apportion(cells["goal"].tolist(), (blocks * most).tolist(), seats)
        # the last block of a line may be a short one
        words = (pd.Series(quota, cells.index, "int64") * block).clip(upper=cells["cell"] * most)
        return cells.assign(words=words)[["shard", "source", "cell", "words"]]

    return of


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: int = 3,
        block: int = BLOCK, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: ``row`` (all its columns), ``size``, ``source_size``, ``target``, ``passes``, ``cut``.

    Sources in code point order, null last, get the weights in turn and share
    ``share`` times the words of all documents; a target stops at ``most`` times
    its source's words. ``passes`` is how often the whole document is taken,
    ``cut`` how many of its first words once more (0, part or all of them), so
    ``passes * size + cut`` words are taken. Null text has no words; a document
    without words is taken 0 times. Null sources are one source. Rows that repeat
    are documents of their own; which of them is cut is not defined, their number
    is. An empty table gives an empty result. More than ``MOST_SOURCES`` sources
    are an error, since their totals come to the driver.
    """
    order = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(source), text_or_empty(text))
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"),
                       F.col(doc_id).alias("id"), word_count(text_or_empty(text)).alias("size"),
                       order.alias("order"))
    many = cells_for(docs.count())
    rows = rows.withColumn("fine", F.col("order").bitwiseAND(many - 1))
    # sums are combined before they move, so a hot source is no hot key
    fine = stored(rows.groupBy("fine", "source").agg(F.sum("size").alias("cell")), "mix-cells")
    totals = few_rows(fine.groupBy("source").agg(F.sum("cell").alias("size"))
                      .orderBy(F.asc_nulls_last("source")), MOST_SOURCES, "sources")
    sizes = [r["size"] for r in totals]
    given = [weights[i % len(weights)] for i in range(len(sizes))]
    targets = source_targets(sizes, given, share * sum(sizes), most)
    shards = max(1, min(many, -(-sum(sizes) // shard_words)))
    parts = [max(1, min(shards, int(min(n, t)) // (block * LEAST_BLOCKS)))
             for n, t in zip(sizes, targets, strict=True)]
    spark = docs.sparkSession
    # at most MOST_SOURCES rows that were on the driver; a join by source would have hot keys
    goals = F.broadcast(spark.createDataFrame(
        [(r["source"], r["size"], t, n) for r, t, n in zip(totals, targets, parts, strict=True)],
        "goal_source string, source_size long, target double, parts long"))
    of_source = F.col("source").eqNullSafe(F.col("goal_source"))
    # parts are spread over the shards, those of different sources from different ones on
    shard = F.expr(f"CAST(((fine * parts DIV {many}) * {shards} DIV parts "
                   f"+ pmod(xxhash64(source), {shards})) % {shards} AS INT)")
    cells = (fine.join(goals, of_source).withColumn("shard", shard)
             .groupBy("shard", "source", "source_size", "target").agg(F.sum("cell").alias("cell"))
             .withColumn("goal", F.when(F.col("source_size") > 0, F.col("target") * F.col("cell")
                                        / F.col("source_size")).otherwise(0.0)))
    quotas = (cells.select("shard", "source", "cell", "goal").groupBy("shard")
              .applyInPandas(_quotas(block, most),
                             "shard int, source string, cell long, words long")
              .select(F.col("shard").alias("q_shard"), F.col("source").alias("q_source"),
                      "cell", "words"))
    line = (Window.partitionBy("shard", "source").orderBy("order", "id", "size")
            .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.join(goals, of_source).withColumn("shard", shard)
              .withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0))))
    last = F.expr("words % cell") - F.col("start")
    return (placed.join(quotas, (F.col("shard") == F.col("q_shard"))
                        & F.col("source").eqNullSafe(F.col("q_source")))
            .select("row", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.expr("words DIV cell")).otherwise(0)
                    .cast("long").alias("passes"),
                    F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("size"), last)))
                    .otherwise(0).cast("long").alias("cut")))


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    source: str = "source", **options) -> DataFrame:
    """The mix as documents: as many copies as it takes, the one at a cut with its first words.

    Columns are those of the input; the text of a part keeps its white space.
    """
    kind = docs.schema[text].dataType
    mixed = mix(docs, text, doc_id, source, **options)
    # pieces of a text that each end with a word; only the few cut documents are split
    whole = F.col("row").getField(text)
    part = F.array_join(F.slice(F.split(whole, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"),
                                F.lit(1), F.col("cut").cast("int")), "")
    copies = F.concat(F.array_repeat(whole, F.col("passes").cast("int")),
                      F.when(F.col("cut") == F.col("size"), F.array_repeat(whole, F.when(
                          F.col("cut") > 0, 1).otherwise(0)))
                      .when(F.col("cut") > 0, F.array(part))
                      .otherwise(F.array().cast("array<string>")))
    return (mixed.select("row", F.explode(copies).alias("copy"))
            .select(*[F.col("copy").cast(kind).alias(c) if c == text
                      else F.col("row").getField(c).alias(c) for c in docs.columns]))
