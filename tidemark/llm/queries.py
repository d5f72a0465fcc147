"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, embeddings, extract, minhash, packing, pii, quality, search, secrets, sharding, trie, urls, whitening,
)
from tidemark.llm.tables import read

SHARDS = 40

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1)).withColumn(
        "law", F.lit("key"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return urls.judge(pages, urls.advert_hosts(pages))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_quality_classifier, op3_html_extraction, op4_embedding_near_dedup,
        op5_secret_scans, op6_sharding, op7_minhash_near_dedup, op8_url_filters, op9_pii, op10_best_fit_packing,
        op11_embedding_whitening, op12_exact_top_k, op13_conversation_trie,
    )
}
ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": decontaminate.ORACLE,
    "op7_minhash_near_dedup": minhash.ORACLE,
    "op8_url_filters": urls.ORACLE,
    "op12_exact_top_k": search.ORACLE,
    "op13_conversation_trie": trie.ORACLE,
}
