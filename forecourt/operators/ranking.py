"""One row per key, first and last per entity, and sequence numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # row_number() = 1 lets Spark keep one row per key and task before the
    # shuffle, so a hot key sends a handful of rows, not all of them.
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__n", F.row_number().over(window))
            .where(F.col("__n") == 1).drop("__n"))


def _tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    taken = {c.lower() for c in used}
    return [F.col(c).asc() for c in sorted(df.columns, key=str.lower) if c.lower() not in taken]


def keep_latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by`` values per key.

    Keys are compared column by column and null is a key value of its own.
    Ties are broken by the remaining columns in name order, so the result does
    not depend on how rows were distributed.
    """
    return _top_one(df, keys, [F.col(c).desc() for c in by] + _tie_break(df, [*keys, *by]))


def keep_first(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``by`` values per key; ties as in ``keep_latest``."""
    return _top_one(df, keys, [F.col(c).asc() for c in by] + _tie_break(df, [*keys, *by]))


def first_and_last(df: DataFrame, entity: Sequence[str], by: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """One row per entity with structs ``first`` and ``last`` of by + payload.

    ``first`` has the smallest (by, payload), ``last`` the greatest. Both come
    from one aggregation that combines on the map side.
    """
    row = F.struct(*by, *payload)
    return df.groupBy(*entity).agg(F.min(row).alias("first"), F.max(row).alias("last"))


def first_non_null(df: DataFrame, keys: Sequence[str], value: str, by: Sequence[str]) -> DataFrame:
    """The non-null ``value`` with the smallest ``by`` per key, null if there is none.

    The order is explicit: "first row that arrives" would change with the
    distribution of the rows.
    """
    order = F.when(F.col(value).isNotNull(), F.struct(*by, value))
    return df.groupBy(*keys).agg(F.min(order)[value].alias(value))


def sequence_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     slices: Sequence[Column], number: str = "seq_nbr",
                     reverse: str | None = None) -> DataFrame:
    """Number the rows of each key 1, 2, ... in ascending ``order``.

    ``order`` must be a total order within a key. ``slices`` cut a key's rows
    into pieces that follow the order (the minute of a timestamp, the date
    itself, a wide bucket of a number): rows are numbered inside a piece and
    the sizes of the earlier pieces are added. No task holds more than one
    piece of a key, however many rows the key has; only piece sizes are summed
    per key. ``reverse`` names an optional column counting from the other end,
    which needs no second sort.
    """
    pieces = [f"__s{i}" for i in range(len(slices))]
    # A struct is never null itself and its null fields compare as equal, so
    # one plain equality serves the window and the join with a single shuffle.
    sliced = (df.withColumns(dict(zip(pieces, slices, strict=True)))
              .withColumn("__piece", F.struct(*keys, *pieces)))
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(*pieces).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (sliced.groupBy("__piece").agg(F.count("*").alias("__n"))
             .select("__piece.*", "__piece", "__n")
             .select(F.col("__piece").alias("__of"),
                     F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
                     F.sum("__n").over(per_key).alias("__all")))
    inside = Window.partitionBy("__piece").orderBy(*order)
    numbered = sliced.withColumn("__in", F.row_number().over(inside))
    joined = numbered.join(sizes, F.col("__piece") == F.col("__of"), "inner")
    place = F.col("__before") + F.col("__in")
    result = {number: place.cast("long")}
    if reverse:
        result[reverse] = (F.col("__all") - place + 1).cast("long")
    return joined.withColumns(result).select(*df.columns, *result)
