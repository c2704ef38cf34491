"""From raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns what goes on; ``run`` writes
each result to the shared folder and reads it for the next stage. All stages but
the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import exact_dedup, mixing, near_dedup, packing, quality
from forecourt.llm.queries import BYTE_VOCABULARY, vocabulary_text
from forecourt.llm.shared import stored


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return quality.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, the longest."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates by shingles of five words, the one with the least id."""
    return near_dedup.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes as often as it is taken."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, each sequence mixed like the whole."""
    return packing.pack(docs, vocabulary_text(BYTE_VOCABULARY))


STAGES = [
    ("quality rules", reject_low_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mix sources", mix_sources),
    ("pack", pack_sequences),
]

# The learned rules and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
