"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import conversations, decontaminate, linespread, minhash, mixing, pii, quality, repair, spotsigs, toxicity, urlfilter, warc, whitening
from tabwright.llm.common import shared_folder, table

TOKENIZER = "byte_bpe_50k.json"


def op1_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of token ids, written and read back."""
    path = shared_folder(spark, "token-shards")
    repair.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return repair.documents_of(spark, path)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_label_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"))


def op6_toxicity_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linespread.line_report(table(spark, sf_dir, "documents"))


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).drop("doc_key")


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.filtered(urlfilter.captures_of(pages), urlfilter.entries_of(pages))


def op10_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op11_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, and every record found through the index and read back."""
    return warc.report(spark, table(spark, sf_dir, "pages"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(spark, table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(spark, table(spark, sf_dir, "conversations"))


#: Name: the query and its SQL twin, or None where tests hold it against brute force.
QUERIES = {
    "op1_repair_tokens": (op1_repair_tokens, None),
    "op2_minhash_near_dedup": (op2_minhash_near_dedup, minhash.ORACLE),
    "op3_pii_weak_supervision": (op3_pii_weak_supervision, None),
    "op4_benchmark_decontamination": (op4_benchmark_decontamination, decontaminate.ORACLE),
    "op5_quality_label_model": (op5_quality_label_model, None),
    "op6_toxicity_string_kernel": (op6_toxicity_string_kernel, None),
    "op7_line_spread": (op7_line_spread, linespread.ORACLE),
    "op8_source_mixture": (op8_source_mixture, mixing.ORACLE),
    "op9_url_lists": (op9_url_lists, urlfilter.ORACLE),
    "op10_spot_signatures": (op10_spot_signatures, spotsigs.ORACLE),
    "op11_warc_index": (op11_warc_index, warc.ORACLE),
    "op12_embedding_whitening": (op12_embedding_whitening, None),
    "op13_conversation_repair": (op13_conversation_repair, conversations.ORACLE),
}
