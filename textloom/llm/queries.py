"""Queries of the training-data operators, one per operator, over the whole of their tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm import (
    best_fit_packing,
    compression_toxicity,
    decontaminate,
    exact_dedup,
    filter_audit,
    jump_shards,
    ranked_search,
    repetition,
    simhash_pigeonring,
    suffix_family,
    text_density,
    token_store,
    warc_store,
)
from textloom.session import ship_package

TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2)


@_query
def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.page_records(_table(spark, sf_dir, "pages"), min_bytes=0)


ORACLE_SQL["op5_warc_archive"] = warc_store.ORACLE_SQL


@_query
def op6_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extract_pages(_table(spark, sf_dir, "pages"))


@_query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=2048, end_id=0)


@_query
def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.document_shards(_table(spark, sf_dir, "documents"), n_shards=40)


@_query
def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return compression_toxicity.score_documents(documents, compression_toxicity.fit(documents, _table(spark, sf_dir, "labels")))


@_query
def op4_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge_documents(_table(spark, sf_dir, "documents"))


@_query
def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pigeonring.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


@_query
def op7_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_family.removal_report(_table(spark, sf_dir, "documents"))


@_query
def op3_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op3_simhash_windows"] = decontaminate.ORACLE_SQL


@_query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=50)


ORACLE_SQL["op11_ranked_search"] = ranked_search.ORACLE_SQL


@_query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(_table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_exact_dedup"] = exact_dedup.ORACLE_SQL


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLE_SQL["op13_filter_audit"] = filter_audit.ORACLE_SQL
