"""The registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm.op1_line_dedup import line_counts, without_repeated_lines
from tripstrata.llm.op10_embedding_dups import near_duplicates
from tripstrata.llm.op11_prefix_trie import prefix_trie
from tripstrata.llm.op12_periodic_runs import periodic_runs
from tripstrata.llm.op13_lm_scores import lm_scores
from tripstrata.llm.op2_license_scan import scan_licenses
from tripstrata.llm.op3_suffix_dedup import dedup_counts
from tripstrata.llm.op4_bottomk_dups import Near, first_of_each_group
from tripstrata.llm.op4_bottomk_dups import near_duplicates as near_duplicate_texts
from tripstrata.llm.op5_bpe import encode_decode
from tripstrata.llm.op6_pseudonyms import pseudonymized
from tripstrata.llm.op7_quality_rules import good_documents, quality
from tripstrata.llm.op8_mixing import mixed_documents, take_mix
from tripstrata.llm.op9_token_counts import count_tokens


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, and how many of them repeat an earlier line exactly or nearly."""
    return line_counts(_table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families that the paragraphs of every document state."""
    return scan_licenses(_table(spark, folder, "documents")).drop("paragraphs")


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without byte strings that occur again."""
    return dedup_counts(_table(spark, folder, "documents"))


def op4_minhash_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Group of every document under links of its four-word shingles."""
    return near_duplicate_texts(_table(spark, folder, "documents"), Near(words=4))


def op5_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, decoded, and both results as digests."""
    return encode_decode(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms for private data. A deployment passes its own key."""
    return pseudonymized(_table(spark, folder, "documents"), key="registered query")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality(_table(spark, folder, "documents"))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, folder, "documents")
    return mixed_documents(docs, F.array(docs["source"])).drop("copies", "taken_for")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token count of every document."""
    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_embedding_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every embedding."""
    return near_duplicates(_table(spark, folder, "embeddings"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(_table(spark, folder, "conversations"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Repeating stretches of words of every document."""
    return periodic_runs(_table(spark, folder, "documents"))


def op13_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every document."""
    return lm_scores(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_minhash_near_dups": op4_minhash_near_dups,
    "op5_bpe_encode_decode": op5_bpe_encode_decode,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_quality_rules": op7_quality_rules,
    "op8_mix_sources": op8_mix_sources,
    "op9_token_counts": op9_token_counts,
    "op10_embedding_near_dups": op10_embedding_near_dups,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lm_scores": op13_lm_scores,
}


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the rules keep."""
    return good_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents without lines that repeat earlier ones, n_chars as the text then has."""
    return without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return first_of_each_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return take_mix(docs, F.array(docs["source"]))


def bpe_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids and decoded text of every document that is left."""
    return encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=False)
