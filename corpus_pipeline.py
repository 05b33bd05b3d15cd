"""The documents of a training corpus, stage by stage: `documents` in, training mix out.

Each stage takes all rows that its predecessor kept; `run` writes them in between, so a lost
executor never reaches back beyond the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordtide.llm import decontaminate, mixing, neardup, rules, spans, suffixes
from wordtide.llm.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that an earlier document has."""
    return spans.as_documents(docs, suffixes.repeated(docs), suffixes.MIN_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, in training order."""
    return mixing.mixed_sources(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("decontamination", decontamination),
    ("source mixing", source_mixing),
]
#: The stages hash and sort by functions that SQL engines do not share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
