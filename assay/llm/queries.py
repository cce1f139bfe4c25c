"""One query per operator, over the whole of its table, with the parameters of
a production run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.scalar import round_doubles
from assay.llm import (alignment, bpe, conversation_trie, embedding_dedup, jaccard_join, language_id, line_dedup, lm_scoring,
                       mixing, quality_qda, quality_rules, sharding, sql, substring_dedup)
from assay.llm.common import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(mixing.mix_sources(table(spark, sf_dir, "documents")).drop("text_hash"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_file())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_groups(table(spark, sf_dir, "documents"), shards=8)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_neighbours(table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    found = language_id.identify(docs, language_id.train(docs.where(~held_out)))
    return found.withColumn("held_out", held_out)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_mix_sources, op3_bpe, op4_quality_rules, op5_jaccard_join, op6_sharding,
    op7_lm_scoring, op8_quality_classifier, op9_embedding_dedup, op10_language_id,
    op11_substring_dedup, op12_tokenizer_alignment, op13_conversation_trie)}
ORACLE = {"op1_line_dedup": sql.LINE_DEDUP.strip(), "op2_mix_sources": sql.MIX_SOURCES.strip(),
          "op5_jaccard_join": sql.JACCARD.strip(), "op11_substring_dedup": sql.SUBSTRING_DEDUP.strip(),
          "op13_conversation_trie": sql.CONVERSATION_TRIE.strip()}
