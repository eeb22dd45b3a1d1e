"""A training-data pipeline over documents: five stages, each an operator of newsmarket.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmarket.llm import decontaminate, mixing, near_dup, token_output, toxicity
from newsmarket.llm.common import read, shared_dir, stored

#: SQL can't express the models of the toxicity and mixing stages.
ORACLE_SQL = None


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_dup.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return decontaminate.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that expected domain tokens match the weights."""
    return mixing.mixed(docs, mixing.quality_domains(read(spark, sf_dir, "labels")), mixing.WEIGHTS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written as ORC and read back; a row for each document written."""
    return token_output.encode_and_digest(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("near_dup", near_copies),
    ("decontaminate", benchmark_leaks),
    ("mixing", mix_to_weights),
    ("token_output", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"{path}/{k}_{name}")
    return docs
