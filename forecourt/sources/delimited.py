"""Delimited feeds with a declared schema.

Every feed lands as text and is then converted column by column, so one bad
value gives a null (and, on request, a rejected row), not a failed job.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from forecourt.functions.dates import parse_date
from forecourt.functions.text import null_if, plain_header, plain_header_text
from forecourt.operators.skew import lookup_join
from forecourt.session import materialize

DATE_FORMATS = ("yyyy-MM-dd",)
FILE_COLUMN = "file_path"
# The line as it came, kept by Spark where the number of fields is not the declared one.
LINE_COLUMN = "line"
FAULTS_COLUMN = "rejected_columns"
TOO_FEW, TOO_MANY = "too few fields", "too many fields"
NO_HEADER, TWO_HEADERS = "no header with the declared columns", "different headers"
# Undeclared columns that a feed with a header may have.
OTHER_COLUMNS = 32


def convert(text: Column, target: DataType, date_formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Feed text to the target type; null when it does not fit."""
    if isinstance(target, StringType):
        return text
    if isinstance(target, DateType):
        return parse_date(text, *date_formats)
    return text.try_cast(target)


def landing_schema(schema: StructType) -> StructType:
    """The same columns, all text."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def convert_columns(landed: DataFrame, schema: StructType, null_tokens: Sequence[str] = ("",),
                    date_formats: Sequence[str] = DATE_FORMATS, keep: Sequence[str] = ()
                    ) -> DataFrame:
    """All-text columns to the declared types; ``keep`` names columns left as they are."""
    return landed.select(
        *[convert(null_if(F.col(f"`{f.name}`"), null_tokens), f.dataType, date_formats)
          .alias(f.name) for f in schema.fields], *keep)


def value_faults(schema: StructType, null_tokens: Sequence[str] = ("",),
                 date_formats: Sequence[str] = DATE_FORMATS,
                 readers: Mapping[str, Column] | None = None) -> list[Column]:
    """Per column its name where the text does not fit the type, else null.

    ``readers`` holds columns that are converted in a way of their own.
    """
    faults = []
    for f in schema.fields:
        text = null_if(F.col(f"`{f.name}`"), null_tokens)
        value = (readers or {}).get(f.name, convert(text, f.dataType, date_formats))
        faults.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    return faults


def field_count(line: Column, sep: str) -> Column:
    """Fields of a line; a separator between quotes is text."""
    outside = r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return F.size(F.split(line, re.escape(sep) + outside, -1))


def count_fault(declared: Column, most: Column, sep: str) -> Column:
    """The fault of lines with fewer or more fields; Spark kept those lines only."""
    n = F.when(F.col(LINE_COLUMN).isNotNull(), field_count(F.col(LINE_COLUMN), sep))
    return F.when(n < declared, TOO_FEW).when(n > most, TOO_MANY)


def with_faults(landed: DataFrame, schema: StructType, sep: str, trailing: int = 0,
                null_tokens: Sequence[str] = ("",), date_formats: Sequence[str] = DATE_FORMATS
                ) -> DataFrame:
    """Rows landed with their line, and what is wrong with each: a wrong number of
    fields, or the columns whose text does not fit. Nothing wrong is an empty list."""
    n = len(schema.fields)
    faults = F.array(count_fault(F.lit(n), F.lit(n + trailing), sep),
                     *value_faults(schema, null_tokens, date_formats))
    return landed.select(*[f"`{f.name}`" for f in schema.fields], FILE_COLUMN, LINE_COLUMN,
                         F.array_compact(faults).alias(FAULTS_COLUMN))


def parted(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with faults. They are written once, to one table, so the feed is
    read and checked once for both."""
    # no folders by fits: a task would sort all its rows to write them
    table = materialize(checked.withColumn("fits", F.size(FAULTS_COLUMN) == 0), "checked")
    good = table.where("fits").drop("fits", FAULTS_COLUMN, LINE_COLUMN)
    return good, table.where("NOT fits").drop("fits")


def checked_schema(schema: StructType, trailing: int) -> StructType:
    """Text columns, room for undeclared last fields, and the line."""
    extra = [StructField(f"__extra{i}", StringType()) for i in range(trailing)]
    return StructType([*landing_schema(schema).fields, *extra,
                       StructField(LINE_COLUMN, StringType())])


def land_delimited(spark: SparkSession, path: str | list[str], schema: StructType,
                   sep: str = ",", header: bool = False, multi_line: bool = False,
                   line: bool = False, trailing: int = 0) -> DataFrame:
    """The feed as text columns by position, plus the file each row came from.

    Fields beyond the declared ones (such as a trailing separator) are dropped,
    missing ones are null; ``line`` adds the line itself where their number is not
    that of the schema and ``trailing`` more. ``path`` may be a glob or a list.
    """
    landing = checked_schema(schema, trailing) if line else landing_schema(schema)
    return (spark.read.schema(landing)
            .option("sep", sep).option("header", header).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE_COLUMN)
            .option("columnPruning", not line)  # fields that are not read are not counted
            .csv(path).select("*", F.col("_metadata.file_path").alias(FILE_COLUMN)))


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType,
                   sep: str = ",", header: bool = False, null_tokens: Sequence[str] = ("",),
                   date_formats: Sequence[str] = DATE_FORMATS, rejects: bool = False,
                   with_file: bool = False, trailing: int = 0
                   ) -> DataFrame | tuple[DataFrame, DataFrame]:
    """A delimited feed with columns by position.

    ``rejects=True`` returns (rows that fit, rejected rows as text): lines with too few
    or too many fields and lines with a value that does not fit its type, each with its
    faults. A line may have up to ``trailing`` undeclared last fields. Both come
    from one read of the feed.
    """
    landed = land_delimited(spark, path, schema, sep, header, line=rejects, trailing=trailing)
    keep = [FILE_COLUMN] if with_file else []
    if not rejects:
        return convert_columns(landed, schema, null_tokens, date_formats, keep)
    good, bad = parted(with_faults(landed, schema, sep, trailing, null_tokens, date_formats))
    return convert_columns(good, schema, null_tokens, date_formats, keep), bad


def join_file(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files with what ``files`` holds, one row at most, of each row's file.

    ``files`` is broadcast: the driver lists the files of a read anyway. Dealt by file, all
    rows of a large file would be in one task.
    """
    return lookup_join(rows, F.broadcast(files), [FILE_COLUMN], "left")


def land_by_header(spark: SparkSession, path: str | list[str], schema: StructType,
                   sep: str = ",", null_tokens: Sequence[str] = ("", "NULL"),
                   date_formats: Sequence[str] = DATE_FORMATS, multi_line: bool = False,
                   prefix: str = "", readers: Mapping[str, Column] | None = None,
                   strict: bool = False) -> DataFrame:
    """Text columns by the header of each row's own file, the file, and the row's faults.

    The files of one read may order their columns differently and may have up to
    ``OTHER_COLUMNS`` undeclared ones. A header is a line with all declared names, tidied
    as in ``read_headed`` and less a ``prefix``, wherever it stands. Quotes inside of
    quotes are doubled. Rows of a file
    without one, or with headers that disagree, are at fault as a whole, with ``strict``
    an error.
    """
    width = len(schema.fields) + OTHER_COLUMNS
    cells = [f"__f{i}" for i in range(width)]
    landing = StructType([StructField(c, StringType()) for c in [*cells, LINE_COLUMN]])
    # every line is shorter than the widest one, so Spark keeps all of them
    raw = (spark.read.schema(landing).option("sep", sep).option("multiLine", multi_line)
           .option("escape", '"').option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE_COLUMN)
           .csv(path).select(F.array(*cells).alias("__cells"), LINE_COLUMN,
                             F.col("_metadata.file_path").alias(FILE_COLUMN)))
    mark = f"^{re.escape(prefix.lower())}_" if prefix else "^$"
    titles = F.transform("__cells", lambda c: F.regexp_replace(plain_header_text(c), mark, ""))
    names = [f.name.lower() for f in schema.fields]
    declared = F.array(*[F.lit(n) for n in names])
    is_header = F.size(F.array_except(declared, titles)) == 0
    places = F.struct(field_count(F.col(LINE_COLUMN), sep).alias("n"), F.transform(
        declared, lambda n: F.array_position(titles, n).cast("int")).alias("at"))
    headers = (raw.where(is_header).select(FILE_COLUMN, places.alias("__places"))
               .groupBy(FILE_COLUMN)
               .agg(F.min("__places").alias("__first"), F.max("__places").alias("__last")))
    rows = join_file(raw.where(~is_header), headers)
    fault = (F.when(F.col("__first").isNull(), NO_HEADER)
             .when(F.col("__first") != F.col("__last"), TWO_HEADERS))
    stop = F.raise_error(F.concat_ws(": ", FILE_COLUMN, fault)) if strict else F.lit(None)
    # which cell is which column is not known then; the line has them all
    row = F.when(fault.isNotNull(), stop.cast("array<string>")).otherwise(
        F.transform("__first.at", lambda i: F.get("__cells", i - 1)))
    n = F.col("__first.n")
    return (rows.select(row.alias("__row"), FILE_COLUMN, LINE_COLUMN,
                        F.coalesce(fault, count_fault(n, n, sep)).alias("__fault"))
            .select(*[F.get("__row", F.lit(i)).alias(f.name)
                      for i, f in enumerate(schema.fields)],
                    FILE_COLUMN, LINE_COLUMN, "__fault")
            .withColumn(FAULTS_COLUMN, F.array_compact(F.array("__fault", *value_faults(
                schema, null_tokens, date_formats, readers)))).drop("__fault"))


def read_by_header(spark: SparkSession, path: str | list[str], schema: StructType,
                   sep: str = ",", null_tokens: Sequence[str] = ("", "NULL"),
                   date_formats: Sequence[str] = DATE_FORMATS, multi_line: bool = False,
                   prefix: str = "", readers: Mapping[str, Column] | None = None,
                   rejects: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """A feed with a header line in every file, columns by the names of that header.

    ``rejects=True`` returns (rows that fit, rejected rows as text) from one read. Else
    values that do not fit are null, short lines lack their last columns, and a file
    whose columns cannot be told is an error.
    """
    landed = land_by_header(spark, path, schema, sep, null_tokens, date_formats, multi_line,
                            prefix, readers, strict=not rejects)
    bad = None
    if rejects:
        landed, bad = parted(landed)
    rows = landed.select(*[
        (readers or {}).get(f.name, convert(null_if(F.col(f"`{f.name}`"), null_tokens),
                                            f.dataType, date_formats)).alias(f.name)
        for f in schema.fields])
    return (rows, bad) if rejects else rows


def read_headed(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",",
                null_tokens: Sequence[str] = ("", "NULL"),
                date_formats: Sequence[str] = DATE_FORMATS, multi_line: bool = False
                ) -> DataFrame:
    """A feed with a header line, columns by tidied header name.

    ``table.column`` names lose the table, line breaks become ``_``, a byte
    order mark is ignored. Columns of the schema must all be there; others are
    dropped. ``multi_line`` is for headers that hold line breaks; such files
    are read in one piece each, so keep it for sheet exports. Files of one read
    must have the same header; Spark fails on a file whose columns differ in name
    or order, so none is read by position.
    """
    raw = (spark.read.option("sep", sep).option("header", True).option("multiLine", multi_line)
           .option("inferSchema", False).option("enforceSchema", False).csv(path))
    tidy = raw.toDF(*[plain_header(c) for c in raw.columns])
    missing = [f.name for f in schema.fields if f.name.lower() not in tidy.columns]
    if missing:
        raise ValueError(f"columns missing in feed: {', '.join(missing)}")
    return convert_columns(tidy, schema, null_tokens, date_formats)
