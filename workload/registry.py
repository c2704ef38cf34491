"""Where queries register, and how their results are made comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, ShortType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as long, decimals as double."""
    def column(field):
        if isinstance(field.dataType, (IntegerType, ShortType)):
            return F.col(field.name).cast("long").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name (less ``_query``), with its SQL."""
    def register(make: Query) -> Query:
        name = make.__name__.removesuffix("_query")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(make(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
