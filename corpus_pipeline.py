"""Corpus pipeline: language, near-duplicates, repeated passages, benchmark passages, packing.

Each stage works on all documents that the one before kept; all but the last return the columns of the
documents. Between stages the documents are written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import table
from sluiceway.llm import blocks, language_id, minhash, packing, sparse_suffix, tiling
from sluiceway.session import to_scratch_table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go."""
    model = language_id.train(docs, blocks.crc_mod(F.col("doc_id"), 4) != 2)
    return language_id.accepted(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one of the least id stays."""
    return minhash.without_near_duplicates(docs, k=5, similarity=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the document of the least id alone."""
    return sparse_suffix.without_repeats(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences of 1024 tokens, with their ids."""
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True, added=added)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_near_copies),
    ("passage_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

#: Hashing, tokenising and learning have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = to_scratch_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
