"""Dimension look-ups and value overrides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.skew import lookup_join


def enrich_left(df: DataFrame, dimensions: Sequence[tuple[DataFrame, Mapping[str, str]]]
                ) -> DataFrame:
    """Left join dimensions, each given with a mapping own column -> its key.

    Each dimension must hold one row per key once full copies are dropped; the
    caller reduces it first where it does not (``keep_latest``). The schema is the
    same at any size; whether a dimension is broadcast is Spark's own decision by
    its measured size.
    """
    joined = df
    for dimension, on in dimensions:
        joined = lookup_join(joined, dimension.distinct(), on, "left")
    return joined


def apply_overrides(df: DataFrame, when_col: str, set_col: str, mapping: Mapping) -> DataFrame:
    """Replace ``set_col`` where ``when_col`` holds one of the mapped values."""
    value = F.col(set_col)
    for name, code in mapping.items():
        value = F.when(F.col(when_col) == name, F.lit(code)).otherwise(value)
    return df.withColumn(set_col, value)
