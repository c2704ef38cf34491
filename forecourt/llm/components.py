"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.shared import stored


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Hang every node's neighbours (the greater ones, or the smaller ones) on its least one."""
    if small:
        sided = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w"))
    else:
        sided = links.select(F.col("a").alias("u"), F.col("b").alias("w")).union(
            links.select("b", "a"))
    least = (sided.groupBy("u").agg(F.min("w").alias("m"))
             .select(F.col("u").alias("v"), F.least("u", "m").alias("m")))
    hung = sided.join(least, F.col("u") == F.col("v")).select("u", "w", "m")
    if not small:  # a row for each link at most, so repeats can wait for the other step
        return hung.where("w > u AND w <> m").select(F.col("w").alias("a"), F.col("m").alias("b"))
    pairs = hung.select(F.col("w").alias("a"), F.col("m").alias("b")).union(
        least.select("v", "m"))
    return pairs.where("a <> b").distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one node at most, and on none if others hang on it."""
    roles = links.select(F.col("a").alias("v"), F.lit(1).alias("hangs")).union(
        links.select("b", F.lit(0)))
    return (roles.groupBy("v").agg(F.sum("hangs").alias("times"), F.min("hangs").alias("least"))
            .where("times > 1 OR times = 1 AND least = 0").isEmpty())


def stars(links: DataFrame) -> DataFrame:
    """(a, b) for every node of ``links`` (long ``a``, long ``b``) but the roots; b is a's root.

    The root is the least node of a component. ``links`` is read twice, so it should be
    a written table. Each step works on written tables, and links stay in them. Rounds
    grow with the logarithm of the longest path. A node that only links to itself, or to
    null, is left out.
    """
    now = links.where("a <> b")
    while True:
        now = stored(_stars(_stars(now, small=False), small=True), "stars")
        if _all_stars(now):
            return now


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links``, the roots included; see ``stars``."""
    leaves = stars(links).select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select("root", "root").distinct())
