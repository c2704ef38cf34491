"""What the text operators share: word rules, tables in the shared folder, hashing."""

from __future__ import annotations

import tempfile
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# White space is these six characters, a word is a run of any others.
# ``bytes.split()`` uses the same six.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# One folder per local session that names none.
_own: dict[str, tempfile.TemporaryDirectory] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may lack it and then gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.TemporaryDirectory(
            prefix="forecourt-llm-", ignore_cleanup_errors=True)
    return _own[context.applicationId].name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the written table.

    It cuts the lineage: a lost executor costs a re-read. The folder goes when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls into no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def crc_fold(doc_id: int | None, parts: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def few_rows(df: DataFrame, most: int, what: str) -> list:
    """Rows of a frame that is small by its nature, or an error: nothing is cut off."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows
