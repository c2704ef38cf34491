"""Compare two frames: row by row as bags, or by counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Buckets of a fingerprint; a difference is looked for in whole buckets.
BUCKETS = 16_384


def _bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *_marked(columns)), F.lit(buckets)).cast("int")


def _marked(columns: Sequence[str]) -> list[Column]:
    # the hash passes over nulls, so they are told apart by flags
    return [F.col(f"`{c}`") for c in columns] + [F.col(f"`{c}`").isNull() for c in columns]


def fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n and four sums of row hashes: the same for the same rows with the same
    copies in any order.

    Fingerprints of parts add up to that of the whole. Rows combine before the shuffle,
    so at most ``buckets`` small rows leave each task. Two bags of rows that differ
    have equal sums with a chance of about 2 to the power of -128 a bucket.
    """
    parts = {}
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *_marked(df.columns))
        parts |= {f"s{seed}_low": h.bitwiseAND(F.lit(0xFFFFFFFF)),
                  f"s{seed}_high": F.shiftrightunsigned(h, 32)}
    hashed = df.select(_bucket(df.columns, buckets).alias("bucket"),
                       *[v.alias(k) for k, v in parts.items()])
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"),
                                        *[F.sum(k).alias(k) for k in parts])


def reconcile_sets(a: DataFrame, b: DataFrame, buckets: int = 0) -> DataFrame:
    """Rows that occur more often on one side, with side and surplus.

    Empty when both hold the same rows the same number of times. Both sides
    are counted in one aggregation that combines on the map side; surplus
    copies come as a number, not as repeated rows. With ``buckets``, for tables that
    are mostly equal, fingerprints are compared first and only the rows of buckets that
    differ are shuffled; both sides are then read twice.
    """
    if buckets:
        b = b.select(*a.columns)
        sides = fingerprint(a, buckets).unionByName(fingerprint(b, buckets))
        sums = [c for c in sides.columns if c != "bucket"]
        # in both, and the same: two rows that agree in every sum
        differ = sides.groupBy("bucket").agg(F.count("*").alias("sides"), *[
            (F.min(c) != F.max(c)).alias(c) for c in sums]).where(
            " OR ".join(["sides = 1", *sums])).select(F.col("bucket").alias("__bucket"))
        a, b = (side.withColumn("__in", _bucket(a.columns, buckets))
                .join(differ, F.col("__in") == F.col("__bucket"), "left_semi").drop("__in")
                for side in (a, b))
    both = (a.withColumn("__one", F.lit(1))
            .unionByName(b.withColumn("__one", F.lit(-1))))
    surplus = both.groupBy(*a.columns).agg(F.sum("__one").alias("__surplus"))
    return surplus.where(F.col("__surplus") != 0).select(
        *a.columns,
        F.when(F.col("__surplus") > 0, "left_only").otherwise("right_only").alias("side"),
        F.abs("__surplus").cast("long").alias("copies"))


def reconcile_counts(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts of both sides per ``by`` value where they differ."""
    tagged = (a.select(*by, F.lit(1).alias("__a"), F.lit(0).alias("__b"))
              .unionByName(b.select(*by, F.lit(0).alias("__a"), F.lit(1).alias("__b"))))
    counts = tagged.groupBy(*by).agg(F.sum("__a").alias("left_rows"),
                                     F.sum("__b").alias("right_rows"))
    return counts.where(F.col("left_rows") != F.col("right_rows"))


def same_rows(a: DataFrame, b: DataFrame, buckets: int = 0) -> bool:
    """True when both frames hold the same rows, copies included."""
    return reconcile_sets(a, b, buckets).isEmpty()
