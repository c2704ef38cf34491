"""Writing tables: overwrite, append, append once, verify."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.change import exclude_keys
from forecourt.session import materialize


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    # the row count comes from the write itself, not from a second run of the plan
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write(df: DataFrame, mode: str, path: str, partition_by: Sequence[str],
           options: Mapping[str, str] | None = None) -> int:
    if partition_by:
        # gather the rows of a folder, so a task writes few folders; Spark splits
        # a folder that holds too much of the data over several tasks
        df = df.hint("rebalance", *partition_by)
    counted, seen = _counted(df)
    counted.write.mode(mode).options(**(options or {})).partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a parquet table; returns the rows written."""
    return _write(df, "overwrite", path, partition_by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Add rows to a parquet table; returns the rows written."""
    return _write(df, "append", path, partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the folders of a partitioned table that the load has rows for.

    All other folders stay as they are, and nothing of the table is read. Loading the
    same rows again changes nothing. Returns the rows written.
    """
    if not partition_by:
        raise ValueError("partition columns are missing")
    return _write(df, "overwrite", path, partition_by, {"partitionOverwriteMode": "dynamic"})


def overwrite_table(df: DataFrame, name: str, path: str) -> int:
    """Replace an external table of the catalog; returns the rows written.

    ``df`` must not read the table itself; ``publish_table`` is for that.
    """
    counted, seen = _counted(df)
    counted.write.mode("overwrite").format("parquet").saveAsTable(name, path=path)
    return seen.get["rows"]


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when no file is there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    # files and folders whose names begin like this are no data
    data = [s for s in files.listStatus(place) if s.getPath().getName()[0] not in "_."]
    return spark.read.parquet(path) if data else None


def rows_to_append(df: DataFrame, existing: DataFrame, keys: Sequence[str],
                   granularity: str = "load") -> DataFrame:
    """What of a load may still be appended.

    ``load``: all of it, or nothing when any of its keys is present already.
    ``key``: the rows whose key is not present. Of a table partitioned by the keys
    only the names of its folders are compared. ``df`` is evaluated several times.
    """
    for key in keys:  # only what can match is read; of a partitioned table, only such folders
        least, most = df.agg(F.min(key)).scalar(), df.agg(F.max(key)).scalar()
        existing = existing.where(F.col(key).between(least, most) | F.col(key).isNull())
    if granularity == "key":
        return exclude_keys(df, existing, keys)
    if granularity != "load":
        raise ValueError("granularity must be 'load' or 'key'")
    incoming = df.select(*keys).distinct()
    # equality per column; a date that is null on both sides counts as present
    match = F.lit(True)
    marks = [f"__e{i}" for i in range(len(keys))]
    for key, mark in zip(keys, marks, strict=True):
        match = match & F.col(key).eqNullSafe(F.col(mark))
    present = incoming.join(existing.select(*keys).distinct().toDF(*marks), match, "left_semi")
    return df.where(~present.exists())


def append_if_new(df: DataFrame, path: str, keys: Sequence[str], granularity: str = "load",
                  partition_by: Sequence[str] = ()) -> int:
    """Append a load once; a second run writes nothing. Returns the rows written.

    The load is evaluated once: it is written to the shared folder, and compared and
    appended from there. Two runs at the same time are not kept apart: schedule one
    writer per table.
    """
    existing = read_if_present(df.sparkSession, path)
    if existing is not None:
        df = rows_to_append(materialize(df, "load"), existing, keys, granularity)
    return append(df, path, partition_by)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a parquet table, summed from the footers of its files; none without it."""
    table = read_if_present(spark, path)
    return 0 if table is None else table.select().count()


def verify_write(spark: SparkSession, path: str, rows: int) -> int:
    """``rows``, the number a write has counted while it ran, if the table at ``path``
    holds as many, else an error. Neither the load nor a data page is read for it."""
    found = stored_rows(spark, path)
    if found != rows:
        raise ValueError(f"{path} holds {found} rows, {rows} were written")
    return rows


def new_files(listing: DataFrame, ledger: DataFrame, name: str = "file_name") -> DataFrame:
    """Files of a listing that the ledger of loaded files does not hold."""
    return exclude_keys(listing, ledger, [name])


def shift_file_date(df: DataFrame, days: int = 1, date_col: str = "file_date") -> DataFrame:
    """Move the effective date of a misdated batch."""
    return df.withColumn(date_col, F.date_add(date_col, days))
