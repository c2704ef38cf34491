"""Tables and views that jobs know by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.read.table(name)


def name_views(frames: dict[str, DataFrame]) -> None:
    """Give frames names for the SQL of this session; a name in use is taken over."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, name: str, path: str) -> int:
    """Create or replace the external parquet table ``name`` below ``path``.

    The rows go to a new folder, and the table is pointed there once all are written:
    ``df`` may read the table itself, whoever reads the old rows goes on, and a failed
    run leaves the table as it was. Older folders are the owner's to clear. Returns the
    rows written.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    rows, schema = seen.get["rows"], spark.read.parquet(folder).schema
    if spark.catalog.tableExists(name):
        if spark.read.table(name).schema == schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return rows
        # other columns: the name is free for a moment
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=folder, source="parquet", schema=schema)
    return rows
