"""Training-corpus pipeline over ``documents``: quality filter, near-duplicate
removal, source mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

Defined results: nulls, empty and very long texts, ties and repeated rows are
handled as the operators' docstrings say; an empty table passes through all
stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm import mixing, near_dedup, quality, sentence_pieces
from lathe.llm.common import table
from lathe.session import materialize

ORACLE_SQL = None  # the classifier and the sampled segmentations are not SQL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.without_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per drawn copy; where a source's quota ends inside a document, its
    text is cut there."""
    got = mixing.mixed(docs)
    return got.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sentence_pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_chars, n_tokens, ids, lossless`` of every copy."""
    return sentence_pieces.encode_rows(docs, sentence_pieces.production_model())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("sentence_pieces", sentence_pieces_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
