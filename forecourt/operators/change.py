"""Change feeds against a published table, and picking the newest load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.skew import lookup_join


def exclude_keys(df: DataFrame, seen: DataFrame, keys: Sequence[str],
                 null_safe: bool = True) -> DataFrame:
    """Rows whose key does not occur in ``seen``.

    Keys are compared column by column. With ``null_safe`` a null key part
    equals null; without it a key with a null is never found, so its row stays.
    """
    known = seen.select(*keys).distinct()
    return lookup_join(df, known, keys, "left_anti", null_safe=null_safe)


def change_feed(new: DataFrame, old: DataFrame, keys: Sequence[str],
                compare_cols: Sequence[str] | None = None, null_safe: bool = True,
                code: str = "src_sys_iud_cd") -> DataFrame:
    """Change rows from a published table ``old`` to a new load.

    I: new rows with a key that was not published. U: new rows with a published
    key, whether or not they differ. D: published rows whose key is gone. With
    ``compare_cols`` a U row equal to a published row in key and these columns
    is left out. Both inputs need the same columns; ``code`` is set here.
    """
    payload = [c for c in new.columns if c.lower() != code.lower()]
    new, old = new.select(*payload), old.select(*payload)
    published = old.select(*keys).distinct().withColumn("__published", F.lit(True))
    # one pass over the new load tells I from U
    tagged = (lookup_join(new, published, keys, "left", null_safe=null_safe)
              .withColumn(code, F.when(F.col("__published"), "U").otherwise("I"))
              .drop("__published"))
    if compare_cols is not None:
        whole = [*keys, *compare_cols]
        same = old.select(*whole).distinct()
        if not null_safe:  # by this rule a null key was never published, so nothing equals it
            same = same.dropna(subset=list(keys))
        tagged = lookup_join(tagged, same, whole, "left_anti", null_safe=True)
    gone = exclude_keys(old, new, keys, null_safe).withColumn(code, F.lit("D"))
    return tagged.unionByName(gone)


def latest_slice(df: DataFrame, by: str) -> DataFrame:
    """Rows that carry the greatest ``by`` value of the whole frame."""
    return df.where(F.col(by) == df.agg(F.max(by)).scalar())
