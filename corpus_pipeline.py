"""The corpus pipeline: the documents that are worth keeping, once, mixed and sharded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mailsift.llm import decontaminate, mixing, quality, sharding, simhash
from mailsift.llm.common import table
from mailsift.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("near-duplicates", single),
    ("decontamination", untested),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Learned scores and fingerprints are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each reading what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
