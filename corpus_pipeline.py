"""From raw documents to shards: five corpus operators, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fiscalframe.llm import decontaminate, language_id, lsh_forest, mixing, sharding
from fiscalframe.llm.shared import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from the labels of the same documents."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity of 0.8 or more."""
    return lsh_forest.drop_near_copies(docs, words=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and place of each document; copies of a text stay together."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The language model cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
