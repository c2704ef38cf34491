"""Joins that keep working when one key holds a large part of the rows.

Spark's own skew handling splits a sort-merge join only when both inputs come
straight from a shuffle. A lookup side that was just made unique per key does
not, so ``lookup_join`` splits hot keys itself: the rows of a hot key are dealt
over several join keys and its one lookup row is repeated for each of them.
The split comes from the values of the row, not from a random number or its
position, so a retried task deals the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than HOT_ROWS rows is split into pieces of about that many.
# Only the HOT_KEYS largest keys are split: each further key holds less than
# 1/HOT_KEYS of the rows, and the list has a fixed bound and can be broadcast.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000

JOIN_KINDS = ("inner", "left", "left_semi", "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Key values with too many rows for one task and ``pieces`` to split them into.

    At most ``HOT_KEYS`` rows. Only the key columns are read, and counts are
    combined before the shuffle. A key that is missing here is joined in one
    piece, so the list decides about balance, never about results.
    """
    size = rows or HOT_ROWS
    return (df.groupBy(*keys).agg(F.expr("count(*) AS __rows"))
            .where(f"__rows > {size}").orderBy(F.desc("__rows"), *keys).limit(HOT_KEYS)
            .select(*keys, F.expr(f"CAST(ceil(__rows / {size}) AS INT) AS pieces")))


def keys_match(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    """Join condition over columns of different names on the two sides."""
    equal = "<=>" if null_safe else "="
    return F.expr(" AND ".join(f"`{a}` {equal} `{b}`" for a, b in zip(left, right, strict=True)))


# The piece of its key a row was dealt to.
PIECE = "__piece_nbr"


def _hot_side(hot: DataFrame, keys: int) -> tuple[DataFrame, list[str]]:
    marks = [f"__h{i}" for i in range(keys)]
    return F.broadcast(hot.toDF(*marks, "__pieces")), marks  # at most HOT_KEYS rows


def deal(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add ``PIECE``: 0, or for rows of hot keys a piece number taken from the row's values."""
    listed, marks = _hot_side(hot, len(keys))
    values = ", ".join(f"`{c}`" for c in df.columns)
    piece = f"CASE WHEN __pieces IS NULL THEN 0 ELSE pmod(xxhash64({values}), __pieces) END"
    return (df.join(listed, keys_match(keys, marks, null_safe=True), "left")
            .withColumn(PIECE, F.expr(f"CAST({piece} AS INT)")).drop(*marks, "__pieces"))


def join_dealt(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str],
               how: str, hot: DataFrame, null_safe: bool = False) -> DataFrame:
    """``lookup_join`` for rows that were dealt before; they keep their piece.

    Joins on the same key one after the other share the shuffle of the rows.
    """
    if how not in JOIN_KINDS:
        raise ValueError(f"how must be one of {JOIN_KINDS}")
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    right_keys = [f"__r{i}" for i in range(len(pairs))]
    listed, marks = _hot_side(hot, len(pairs))
    taken = {v.lower() for v in pairs.values()}
    named = right.selectExpr(
        *[f"`{v}` AS {r}" for v, r in zip(pairs.values(), right_keys, strict=True)],
        *[f"`{c}`" for c in right.columns if c.lower() not in taken])
    repeated = (named.join(listed, keys_match(right_keys, marks, null_safe=True), "left")
                .withColumn("__rp", F.expr("explode(sequence(0, coalesce(__pieces, 1) - 1))"))
                .drop(*marks, "__pieces"))
    match = keys_match(list(pairs), right_keys, null_safe) & (F.col(PIECE) == F.col("__rp"))
    return left.join(repeated, match, how).drop(*right_keys, "__rp")


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Mapping[str, str],
                how: str = "inner", *, null_safe: bool = False,
                hot: DataFrame | None = None) -> DataFrame:
    """Join ``left`` with a side that has **at most one row per key**.

    ``on`` is a list of shared names or a mapping left name -> right name; the
    right key columns are not repeated in the result. It is a plain join, whose
    skew Spark handles, unless ``hot`` asks for splitting: what ``hot_keys`` gives
    for the left keys, or for those of a cheaper input with the same keys.
    """
    if hot is not None:
        return join_dealt(deal(left, list(on), hot), right, on, how, hot, null_safe).drop(PIECE)
    if how not in JOIN_KINDS:
        raise ValueError(f"how must be one of {JOIN_KINDS}")
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    marks = [f"__r{i}" for i in range(len(pairs))]
    taken = {v.lower() for v in pairs.values()}
    named = right.selectExpr(
        *[f"`{v}` AS {r}" for v, r in zip(pairs.values(), marks, strict=True)],
        *[f"`{c}`" for c in right.columns if c.lower() not in taken])
    return left.join(named, keys_match(list(pairs), marks, null_safe), how).drop(*marks)
