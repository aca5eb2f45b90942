"""The corpus pipeline: five stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygate.llm import mixing, quality_cnn, quality_rules, sentencepiece_bpe, simhash
from tallygate.llm.common import shared_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from all labelled documents."""
    everything = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = quality_cnn.learn(everything, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.keep_good(docs, network)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.keep_one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their digest, and that of the text they decode to."""
    return sentencepiece_bpe.tokens(docs, sentencepiece_bpe.default_model())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("simhash near-dedup", near_dedup),
    ("mixing sources", mix),
    ("sentencepiece", tokenize),
]

#: The classifier and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs
