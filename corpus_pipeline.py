"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import line_dedup, near_dedup, packing, quality, repeats
from oreflow.llm.frames import cut, table


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars as long as the changed text."""
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    rules = quality.learned(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, rules).where("kept").select("row.*")


def _left(removed: str, text: str = "text") -> Column:
    """Whether a text still has a word, or lost nothing."""
    return (F.col(removed) == 0) | F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go from the texts, and documents that were nothing else."""
    return _with_text(docs, line_dedup.dedup_lines(docs).where(_left("n_removed")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: similar by 0.8 or more."""
    return near_dedup.distinct_documents(docs, 80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stood earlier go from the texts, and documents that were nothing else."""
    cleaned = repeats.remove_repeats(docs, whole_characters=True).select(
        "row.*", F.col("n_removed").alias("_removed"), F.col("kept").cast("string").alias("_kept"))
    rest = cleaned.where(_left("_removed", "_kept")).withColumn("text", F.col("_kept"))
    return _with_text(docs, rest.drop("_removed", "_kept"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece lies in the training sequences."""
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut(pieces.drop("ids")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_runs),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed_sequences),
]

#: Learned rules and tokenizers can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
