"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wirelake.llm import (
    byte_bpe, chat_format, exact_dedup, filter_audit, fingerprints, mixing, near_dedup, passage_dedup, perplexity, prefix_trie,
    secret_scan, token_count, toxicity,
)
from wirelake.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secret_scan.digest_columns(secret_scan.find_secrets(docs, secret_scan.train(docs)))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.repeated_spans(read_table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(conversations), conversations)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat_format.with_planted(read_table(spark, sf_dir, "conversations"))
    return chat_format.digest_columns(chat_format.format_chats(chats))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1_mixing,
        "op2_secret_scan": op2_secret_scan,
        "op3_perplexity": op3_perplexity,
        "op4_near_dedup": op4_near_dedup,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_passage_dedup": op6_passage_dedup,
        "op7_token_count": op7_token_count,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_toxicity": op9_toxicity,
        "op10_fingerprints": op10_fingerprints,
        "op11_filter_audit": op11_filter_audit,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_chat_format": op13_chat_format,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op1_mixing": mixing.ORACLE,
        "op5_exact_dedup": exact_dedup.ORACLE,
        "op11_filter_audit": filter_audit.ORACLE,
        "op12_prefix_trie": prefix_trie.ORACLE,
        "op13_chat_format": chat_format.ORACLE,
    }
