"""A training-corpus pipeline of five operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``. Rows are told
apart by id and text hash, so a repeated row shares its twin's fate.

Nulls: a null text has no words, so the quality rules reject it. Null ids go
through; they are never near duplicates. Empty table: no rows. Extra columns are
carried along up to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, jaccard_join, line_dedup, mixing, quality_rules
from assay.llm.common import table, written
from assay.llm.queries import tokenizer_file

#: SQL has no byte-pair encoding and no such hash buckets.
ORACLE_SQL = None
ID, HASH = "_stage_doc_id", "_stage_text_hash"


def _same_row(docs: DataFrame, rows: DataFrame):
    return docs["doc_id"].eqNullSafe(rows[ID]) & (F.xxhash64(docs["text"]) == rows[HASH])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    judged = written(quality_rules.quality_rules(docs, table(spark, sf_dir, "labels")).select("doc_id", "text_hash", "kept"), "judged")
    rejected = judged.where(~F.col("kept")).select(F.col("doc_id").alias(ID), F.col("text_hash").alias(HASH))
    return docs.join(rejected, _same_row(docs, rejected), "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go; so does a document that loses its every line."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    plain = line_dedup.line_dedup(docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(others)]),
                                  carry=[f"_c{i}" for i in range(len(others))])
    left = written(plain, "cut-lines").where((F.col("n_removed") == 0) | (F.coalesce(F.col("text"), F.lit("")) != ""))
    out = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col(f"_c{i}") for i, c in enumerate(others)}
    if "n_chars" in out:
        out["n_chars"] = F.char_length("text").cast("long")
    return left.select(*[out[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents (five-word shingles, similarity 0.8 or
    more) the one with the smallest id stays, and one of each set of repeated rows."""
    found = jaccard_join.jaccard_components(docs, width=5, percent=80)
    gone = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias(ID)).distinct(), "duplicates")
    left = docs.join(gone, docs["doc_id"] == gone[ID], "left_anti")
    return left.dropDuplicates(["doc_id", "text"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, block by block."""
    drawn = mixing.mix_sources(docs).select(F.col("doc_id").alias(ID), F.col("text_hash").alias(HASH),
                                            F.col("block").alias("_stage_block"), F.col("slot").alias("_stage_slot"))
    placed = docs.join(drawn, _same_row(docs, drawn))
    return (placed.repartition("_stage_block").sortWithinPartitions("_stage_block", "_stage_slot")
            .select(*[docs[f"`{c}`"] for c in docs.columns]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    return bpe.bpe_digests(docs, tokenizer_file(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality), ("line_dedup", lines), ("jaccard_join", near_duplicates),
    ("mix_sources", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
