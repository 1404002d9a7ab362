"""One query per operator, over whole tables with production parameters, and their SQL where there
is any. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.llm import (
    alignment, chat, ctw, decontaminate, embedding, extraction, merkle, mixing, quality, sharding, simhash,
    suffix_dedup, warc,
)
from mailsift.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", F.round("covered", 6).alias("covered")).distinct()


@query
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.read_back(chat.formatted(rows.unionByName(extra))))


@query
def op7_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op9_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.lower_cased())


@query
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))
