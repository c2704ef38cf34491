"""Where jobs may put files that every executor has to see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# folders of local sessions without the setting, removed when Python ends
_own: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own, once. Any
    other session without it is an error: a machine-local folder would not be
    visible to the executors.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="forecourt-", ignore_cleanup_errors=True)
    return _own[context.applicationId].name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and continue from the written table.

    For a frame that several branches of a job start from: it is computed once,
    and a lost executor costs a re-read, not the work before it. The table goes when the
    application ends.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
