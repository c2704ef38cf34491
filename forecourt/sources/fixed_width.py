"""Text feeds with a header record and fixed-width detail lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from forecourt.sources.delimited import FILE_COLUMN, convert

HEADER_PREFIX = "HDR"


@dataclass(frozen=True)
class Field:
    """A slice of the line: start counts from 1."""

    name: str
    start: int
    length: int
    dtype: DataType
    date_format: str = "MMddyyyy"

    def text(self, line: Column) -> Column:
        cut = F.trim(F.substring(line, self.start, self.length))
        return F.when(cut != "", cut)

    def value(self, line: Column) -> Column:
        return convert(self.text(line), self.dtype, [self.date_format])


@dataclass(frozen=True)
class FixedWidthLayout:
    """Name and fields of one kind of feed."""

    name: str
    fields: tuple[Field, ...]

    @property
    def width(self) -> int:
        return max(f.start + f.length - 1 for f in self.fields)

    @property
    def schema(self) -> StructType:
        return StructType([StructField(f.name, f.dtype) for f in self.fields])


def land_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines with the file they came from."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias(FILE_COLUMN))


def is_header(line: Column, prefix: str = HEADER_PREFIX) -> Column:
    return line.startswith(prefix)


def read_text_feed(spark: SparkSession, path: str | list[str],
                   header_prefix: str = HEADER_PREFIX) -> DataFrame:
    """Detail lines of a feed; header records are dropped."""
    return land_text(spark, path).where(~is_header(F.col("value"), header_prefix))


def parse_fixed_width(df: DataFrame, layout: FixedWidthLayout, col: str = "value",
                      keep: Sequence[str] = ()) -> DataFrame:
    """Cut lines into typed columns; what is missing or does not fit is null."""
    line = F.col(col)
    return df.select(*[f.value(line).alias(f.name) for f in layout.fields], *keep)


def rejected_lines(df: DataFrame, layout: FixedWidthLayout, col: str = "value",
                   fitting: bool = False) -> DataFrame:
    """Lines that are too short or hold a field that does not fit its type, with their
    faults; ``fitting`` gives the others."""
    line = F.col(col)
    faults = [F.when(f.text(line).isNotNull() & f.value(line).isNull(), F.lit(f.name))
              for f in layout.fields]
    short = F.when(F.length(line) < layout.width, F.lit("line too short"))
    checked = df.withColumn("rejected_columns", F.array_compact(F.array(short, *faults)))
    if fitting:
        return checked.where(F.size("rejected_columns") == 0).drop("rejected_columns")
    return checked.where(F.size("rejected_columns") > 0)
