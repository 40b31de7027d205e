"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.catalog.base import table
from sluiceway.llm import alignment, blocks, imatch, language_id, language_model, minhash, packing, quality, rank_merge, rendezvous, sparse_suffix, sql, tiling, tool_calls, variants


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), added=added)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.held_out_rule()
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"), ~held_out), held_out)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"), blocks.crc_mod(F.col("doc_id"), 10) != 0)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.compare_with_edits(docs, imatch.lexicon(docs))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", F.size("tiles").cast("long").alias("n_tiles"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = sparse_suffix.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"), F.col("first").alias("first_holder"))


TOOLS = [("reply", ["text", "turn"], {"text": "string", "turn": "integer"}), ("follow", ["text"], {"text": "string", "turn": "integer"})]


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    tools = spark.createDataFrame(TOOLS, "name string, required array<string>, properties map<string,string>")
    return tool_calls.formatted(calls, results, tools)


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = blocks.crc_mod(F.col("doc_id"), 4) == 2
    return language_id.predict(docs, language_id.train(docs, ~held_out), held_out)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.placements(table(spark, sf_dir, "documents"), [1.0] * 8)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rank_merge.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontamination": op5_decontamination,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_tool_calls": op7_tool_calls,
    "op8_near_dups": op8_near_dups,
    "op9_language": op9_language,
    "op10_sharding": op10_sharding,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES: dict[str, str] = sql.ORACLES
