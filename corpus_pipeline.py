"""Corpus pipeline: documents through stages, each written as Parquet and read again by the next.

Defined results: a document without text, or with an empty one, goes at the first stage; rows that repeat, or
share or lack a doc_id, are rows of their own until the second stage keeps one of each linked group; very
long texts are read whole by every stage; ties go by the rules of each operator; an empty table gives an empty
result; extra columns, of any name, are kept up to the last stage, which returns shards and slots.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import decontamination, jaccard, mixing, quality, sharding
from courtline.llm.common import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the verdict on their host rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group stays: that with the least doc_id."""
    return jaccard.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times."""
    return mixing.repeat_to_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, along the curve; repeats of a document take slots of their own."""
    return sharding.contract(sharding.shard(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

# Later stages keep one document of each linked group and fit document rates: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"stage{i}")
    return docs
