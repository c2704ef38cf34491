"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (
    exact_dedup,
    hmm,
    language,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    pseudonyms,
    quality,
    secret_scan,
    sentence_pieces,
    spelling,
    token_counts,
)
from forecourt.llm.shared import text_or_empty

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
# A real job passes its own secret.
PSEUDONYM_KEY = "an example key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_text(name: str) -> str:
    """A public vocabulary file; a few MB that tasks get with their function."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def vocabulary_pieces(name: str) -> list[str]:
    """The text pieces of a public vocabulary, without control and byte entries."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("passes") * F.col("size") + F.col("cut")).alias("taken"))


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counts = [(F.size("kinds") - F.size(F.array_remove("kinds", name))).cast("long")
              .alias(f"n_{name}") for name in pseudonyms.KINDS]
    return pseudonyms.pseudonymised(docs, PSEUDONYM_KEY).select(
        "row.doc_id", F.col("safe").alias("text"), *counts)


def op3_word_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = token_counts.LongestMatch(vocabulary_pieces(PIECE_VOCABULARY))
    return token_counts.token_counts(documents(spark, sf_dir), automaton)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", F.sha2(exact_dedup.normalised(text_or_empty()), 256).alias("text_sha256"))
    return exact_dedup.exact_groups(docs).select(
        "row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")


def op5_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), shingle=4)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judged(docs, labels).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_secret_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.secrets(docs, secret_scan.train(docs))


def op8_pack_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_text(BYTE_VOCABULARY))


def op9_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op10_hidden_markov_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.damaged_words(documents(spark, sf_dir).select("doc_id", "text"))
    return spelling.spelling_variants(words)


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(PIECE_VOCABULARY), "rb") as file:
        model = sentence_pieces.PieceModel(file.read())
    texts = sentence_pieces.decode(
        sentence_pieces.encode(documents(spark, sf_dir), model), model)
    return texts.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_feistel_pseudonyms, op3_word_piece_counts, op4_exact_dedup,
        op5_bottom_k_near_dedup, op6_quality_rules, op7_secret_field, op8_pack_mixture,
        op9_string_kernel_language, op10_hidden_markov_score, op11_spelling_variants,
        op12_sentence_pieces, op13_prefix_trie)}

ORACLES: dict[str, str] = {}

# DuckDB deletes the six characters with translate as well; chr(11) and chr(12) have no escape.
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
ORACLES["op4_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256({_NORM}) AS h FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS kept,
       h AS text_sha256
FROM d"""
