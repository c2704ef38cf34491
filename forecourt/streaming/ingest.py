"""Load the files that arrived since the last run, each of them once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StructType

from forecourt.sources.delimited import (FILE_COLUMN, LINE_COLUMN, checked_schema,
                                         landing_schema)
from forecourt.sources.fixed_width import HEADER_PREFIX, is_header

BATCH_COLUMN = "batch_id"


def _arrivals(spark: SparkSession, glob: str, archive: str | None) -> DataStreamReader:
    """New files of a folder and the folders in it; with ``archive`` files that are
    loaded move there when the next batch, or the next run, starts."""
    reader = (spark.readStream.option("pathGlobFilter", glob)
              .option("recursiveFileLookup", True))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def stream_delimited(spark: SparkSession, folder: str, schema: StructType, sep: str,
                     glob: str = "*", archive: str | None = None, line: bool = False,
                     trailing: int = 0) -> DataFrame:
    """New files of a delimited feed as text columns, with their file; ``line`` and
    ``trailing`` as in ``land_delimited``."""
    landing = checked_schema(schema, trailing) if line else landing_schema(schema)
    return (_arrivals(spark, glob, archive).schema(landing).option("sep", sep)
            .option("columnNameOfCorruptRecord", LINE_COLUMN)
            .option("columnPruning", not line).csv(folder)
            .select("*", F.col("_metadata.file_path").alias(FILE_COLUMN)))


def stream_lines(spark: SparkSession, folder: str, glob: str = "*",
                 archive: str | None = None) -> DataFrame:
    """All lines of new files, header records included, with their file."""
    return (_arrivals(spark, glob, archive).text(folder)
            .select("value", F.col("_metadata.file_path").alias(FILE_COLUMN)))


def stream_text(spark: SparkSession, folder: str, header_prefix: str = HEADER_PREFIX,
                glob: str = "*") -> DataFrame:
    """Detail lines of new files of a fixed-width feed, with their file."""
    return stream_lines(spark, folder, glob).where(~is_header(F.col("value"), header_prefix))


def ingest_new_files(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], out: str,
                     checkpoint: str) -> StreamingQuery:
    """Append all files not loaded before to a parquet table, then stop.

    ``checkpoint`` remembers the files, so a second run adds nothing and a
    failed run is completed by the next one. Wait with ``awaitTermination``.
    """
    return (parse(stream).writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_batches(stream: DataFrame, split: Callable[[DataFrame], Mapping[str, DataFrame]],
                   checkpoint: str) -> StreamingQuery:
    """Load all files not loaded before into several tables, then stop.

    ``split`` makes a frame for each table's path out of the files of a batch; it may
    join and aggregate, as files come whole. Every batch has a folder of its own in
    each table and replaces it, so a batch that failed after its first table is done
    again by the next run without doubles. Read the tables with ``read_batches``.
    """
    def load(files: DataFrame, batch: int) -> None:
        # several tables, one read of the files
        files = files.persist()
        try:
            for path, rows in split(files).items():
                rows.write.mode("overwrite").parquet(f"{path}/{BATCH_COLUMN}={batch}")
        finally:
            files.unpersist()

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``ingest_batches`` has put into a table."""
    return spark.read.parquet(path).drop(BATCH_COLUMN)
