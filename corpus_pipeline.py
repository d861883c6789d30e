"""Cleaning a document table: every stage reads what the stage before kept.

Each stage is one of the training-data operators and takes (spark, docs, sf_dir).
``run`` writes every stage's rows as Parquet into the shared folder and reads them
back, so a lost executor costs one stage's tasks and never an earlier stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerscope.llm.common import read_table, scratch_path
from ledgerscope.llm.content_dedup import drop_exact_duplicates
from ledgerscope.llm.ngram_join import keep_one_of_each
from ledgerscope.llm.packing import pack_documents
from ledgerscope.llm.paragraphs import drop_passages
from ledgerscope.llm.rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts stays, the one with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are similar at 0.8 in their word 5-grams, and of those
    linked by such, the one with the smallest doc_id stays."""
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copied passages stay in the document with the smallest doc_id only."""
    return drop_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row for each piece of a document."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Weak supervision and similarity components can't be written as one SQL
#: statement of sensible size; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
