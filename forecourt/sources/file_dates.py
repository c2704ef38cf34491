"""The day a feed file belongs to, from its name or its header record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.dates import parse_date, sales_through
from forecourt.sources.delimited import FILE_COLUMN, join_file
from forecourt.sources.fixed_width import HEADER_PREFIX, is_header


# eight digits in the file name
FILE_DATE = r"(\d{8})[^/]*$"


def with_file_date(df: DataFrame, pattern: str = FILE_DATE, fmt: str = "yyyyMMdd",
                   path_col: str = FILE_COLUMN, name: str = "file_date") -> DataFrame:
    """Add the date found in the file name (first group of ``pattern``)."""
    return df.withColumn(name, parse_date(F.regexp_extract(path_col, pattern, 1), fmt))


def with_header_date(raw: DataFrame, start: int = 9, length: int = 10, fmt: str = "MM/dd/yyyy",
                     header_prefix: str = HEADER_PREFIX, name: str = "file_date") -> DataFrame:
    """Detail lines with the date in their file's header record.

    ``raw`` holds all lines with their file (``land_text``). Lines of a file
    without a header keep a null date.
    """
    header = is_header(F.col("value"), header_prefix)
    date = parse_date(F.substring("value", start, length), fmt)
    dates = raw.where(header).groupBy(FILE_COLUMN).agg(F.min(date).alias(name))
    return join_file(raw.where(~header), dates)


def report_dates(df: DataFrame, file_date: str = "file_date") -> DataFrame:
    """Report date of a snapshot file and the day its sales run through."""
    return df.withColumns({"rpt_dt": F.col(file_date),
                           "sales_through_dt": sales_through(F.col(file_date))})
