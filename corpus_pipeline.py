"""From raw documents to token shards: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import decontaminate, minhash, mixing, repair, toxicity
from tabwright.llm.common import shared_folder, table
from tabwright.llm.queries import TOKENIZER


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels of ``docs``, scores below one half."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_copies(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule leaves."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shards, written, and per document what is read back from them."""
    path = shared_folder(spark, "token-shards")
    repair.write_shards(docs, path, public_tokenizers.path(TOKENIZER))
    return repair.documents_of(spark, path)


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("source_mixing", to_target_weights),
    ("token_output", token_shards),
]

#: The first stage scores with a trained model: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
