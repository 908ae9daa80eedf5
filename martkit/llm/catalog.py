"""The operators' registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martkit.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    lang_id,
    licenses,
    lm_score,
    near_dedup,
    prefix_trie,
    quality,
    sharding,
    suffix_dedup,
    token_files,
    url_lists,
)
from martkit.llm.tables import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.document_repeats(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.page_verdicts(table(spark, sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.document_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.document_languages(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.document_scores(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_quality(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_files.document_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_quality_rules": op7_quality_rules,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_token_files": op11_token_files,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op2_url_filters": url_lists.PAGE_VERDICTS_SQL,
    "op7_quality_rules": quality.DOCUMENT_QUALITY_SQL,
    "op9_decontamination": decontaminate.CONTAMINATED_SQL,
    "op12_prefix_trie": prefix_trie.CONVERSATION_TRIE_SQL,
    "op13_source_divergence": divergence.SOURCE_AUDIT_SQL,
}
